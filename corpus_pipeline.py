"""The corpus pipeline: language, near duplicates, contamination, secrets, packing.

Each stage takes what its predecessor kept, as a table of documents, and is judged on that
input. Stages 1 to 4 return the columns of documents, the last one returns the pieces of the
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.spread import materialize
from tierline.llm import decontamination, language, near_dedup, packing, secrets

#: Documents in which no language labels this share of the letters are rejected.
LEAST_SHARE = 0.4
#: Near duplicates share this percentage of their five-word shingles.
SHINGLE, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those that no language dominates, each row by its own text."""
    model = language.train(docs.filter(~F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))))
    # The row goes through the model with its text, so that no id has to find it again.
    found = language.identify(docs, model, whole_rows=True)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("doc_id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates, whatever rows share an id."""
    return near_dedup.keep_one(docs, shingle=SHINGLE, percent=PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which windows shared with the benchmark hit five percent of the words or more."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; keeps every document."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), measure=packing.crc32_of, schema="ids_crc32 long")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Models and token ids are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
