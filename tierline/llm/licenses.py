"""License scan: headers and licence files against templates, and inheritance along directories.

Every line of every whole text is a possible header, and so is every run of consecutive lines with
at most ``RUN`` times the terms of the longest template, wherever it starts; lines without terms
do not count, so a comment or paragraph of that length is such a run. Lines, runs and whole texts
are compared with templates by TF-IDF cosine: inverse document frequencies of the templates' terms
are counted over all files, a term of no template weighs as one that no file holds. A line, run or
text that lacks a number of a template (a version) is none of it. Whole licence texts are told by their title, which
is a run of lines; of two licences with one wording (BSD with two and three clauses) the template's one is reported. A line or run of ``HEADER`` similarity or more
gives its file a licence of its own; a file is a licence file of its directory if
its name says so and it has a licence of its own, or if its whole text reaches ``WHOLE``. A file
without a licence of its own takes that of the nearest directory above it (or its own) that has a
licence file.

Terms are runs of letters, digits and non-ASCII characters, A-Z folded. Ties go to the more similar,
then the smaller licence id; of several licence files of a directory the most similar counts, then
the smaller path. Null and empty texts match nothing but still inherit; null paths have no directory.
Repeated rows get the same result each. Only ``path`` and ``text`` are read, other columns stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.spread import materialize
from tierline.llm.common import query, read
from tierline.llm.hashing import Words, slices

HEADER = 0.75
WHOLE = 0.5
RUN = 2
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

# Short notices and titles of whole licence texts by SPDX id.
TEMPLATES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_KEPT = np.zeros(256, bool)
_KEPT[0x30:0x3A] = _KEPT[0x41:0x5B] = _KEPT[0x61:0x7B] = _KEPT[0x80:] = True


def _terms(text: str) -> list[int]:
    return Words(pa.array([text]), _KEPT).hash.tolist()


class Templates:
    """Unit TF-IDF vectors of the templates; ``idf`` by term hash, ``unseen`` for all other terms."""

    def __init__(self, templates: tuple[tuple[str, str], ...], files: int, holding: dict[int, int]) -> None:
        counts = [Counter(_terms(t)) for _, t in templates]
        self.names = [n for n, _ in templates]
        self.unseen = math.log(1 + files) + 1
        self.idf = {t: math.log((1 + files) / (1 + holding.get(t, 0))) + 1 for c in counts for t in c}
        self.vectors = []
        for c in counts:
            v = {t: n * self.idf[t] for t, n in c.items()}
            norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
            self.vectors.append({t: x / norm for t, x in v.items()})
        self.numbers = [set(_terms(" ".join(re.findall(r"\b[0-9]+\b", t)))) for _, t in templates]
        self.longest = max((sum(c.values()) for c in counts), default=0)

    def best(self, terms: Counter, *, numbers: bool = True) -> tuple[float, str] | None:
        """Largest cosine and its licence; with ``numbers`` only of templates whose numbers are all among the terms."""
        weights = {t: n * self.idf.get(t, self.unseen) for t, n in terms.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        found = [(sum(w * v[t] for t, w in weights.items() if t in v) / norm, name) for name, v, own in zip(self.names, self.vectors, self.numbers) if not numbers or own <= terms.keys()] if norm else []
        return min(found, key=lambda f: (-round(f[0], 9), f[1]), default=None)


def frequencies(files: DataFrame, templates=TEMPLATES) -> tuple[int, dict[int, int]]:
    """Number of files and, for each term of the templates, of files that hold it: counted over all files."""
    vocabulary = np.array(sorted({t for _, text in templates for t in _terms(text)}), np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, files = np.zeros(len(vocabulary), np.int64), 0
        for part in slices(batches, "text"):
            words = Words(part.column(0), _KEPT)
            at = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
            hit = vocabulary[at] == words.hash
            row = np.repeat(np.arange(part.num_rows), words.counts())[hit]
            held += np.bincount(np.unique(row * len(vocabulary) + at[hit]) % len(vocabulary), minlength=len(vocabulary))
            files += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(vocabulary))], pa.int64()), pa.array([files, *held], pa.int64())], names=["term", "n"])

    rows = files.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    return found.get(-1, 0), {int(t): found.get(i, 0) for i, t in enumerate(vocabulary)}


def _runs(words: Words, hit: np.ndarray, at: np.ndarray, weight: np.ndarray, vectors: np.ndarray, unseen: float, longest: int, header: float):
    """First word, end and largest possible cosine of the runs of two and more lines that can reach ``header``, best first in each row.

    The possible cosine takes every unknown term as a different one, so it is never too small.
    """
    line = np.searchsorted(np.flatnonzero(words.data == 0x0A), words.start)
    row = np.repeat(np.arange(len(words.rows) - 1), words.counts())
    heads = np.flatnonzero((np.diff(line, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    ends = np.append(heads[1:], len(line))
    first = np.arange(len(heads))
    known = np.concatenate([[0], np.cumsum(hit)])
    first = first[known[ends] > known[heads]]
    terms = np.concatenate([[0.0], np.cumsum(np.where(hit, weight[at], unseen**2))])
    hits = np.concatenate([[0.0], np.cumsum(np.where(hit, weight[at], 0.0))])
    starts, stops = [], []
    for k in range(1, longest):
        first = first[first + k < len(heads)]
        last = first + k
        first = first[(row[heads[last]] == row[heads[first]]) & (ends[last] - heads[first] <= longest)]
        if not len(first):
            break
        a, b = heads[first], ends[first + k]
        good = (hits[b] - hits[a] >= header * header / 4 * (terms[b] - terms[a])) & (known[b] > known[heads[first + k]])
        starts.append(a[good]), stops.append(b[good])
    start, stop = np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.int64), *stops])
    bound = np.zeros(len(start))
    root = np.sqrt(weight)
    for p in range(0, len(start), 2048):
        a, b = start[p : p + 2048], stop[p : p + 2048]
        place = a[:, None] + np.arange(longest)
        inside = place < b[:, None]
        place = np.minimum(place, len(hit) - 1)
        seen = inside & hit[place]
        counts = np.zeros((len(a), len(weight)))
        np.add.at(counts, (np.nonzero(seen)[0], at[place[seen]]), 1)
        tf = counts * root
        norm = np.sqrt((tf * tf).sum(axis=1) + unseen**2 * (inside & ~seen).sum(axis=1))
        bound[p : p + 2048] = (tf @ vectors.T).max(axis=1) / norm
    keep = np.flatnonzero(bound >= header - 1e-9)
    keep = keep[np.lexsort((-bound[keep], row[start[keep]]))]
    return start[keep], stop[keep], bound[keep], row[start[keep]]


def own_licenses(files: DataFrame, model: Templates, *, header: float = HEADER) -> DataFrame:
    """``files`` with own_license, own_score (best line or run of ``header`` or more), own_line (its first), whole_license and whole_score."""
    known = np.array(sorted(model.idf), np.uint64)
    weight = np.array([model.idf[int(t)] ** 2 for t in known])
    vectors = np.array([[v.get(int(t), 0.0) for t in known] for v in model.vectors])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column(part.schema.get_field_index("text")), _KEPT)
            breaks = np.flatnonzero(words.data == 0x0A)
            at = np.minimum(np.searchsorted(known, words.hash), max(len(known) - 1, 0))
            hit = (known[at] == words.hash) if len(known) else np.zeros(len(words.hash), bool)
            out = []
            runs = _runs(words, hit, at, weight, vectors, model.unseen, RUN * model.longest, header) if hit.any() else None
            for i in range(part.num_rows):
                a, b = words.rows[i], words.rows[i + 1]
                best, line_no, whole = None, None, None
                if hit[a:b].any():
                    total = np.where(hit[a:b], weight[at[a:b]], model.unseen**2)
                    # A text or line can only reach a similarity if enough of its weight lies in known terms.
                    if (total * hit[a:b]).sum() >= 0.05 * total.sum():
                        whole = model.best(Counter(words.hash[a:b].tolist()))
                    first = np.searchsorted(breaks, words.offsets[i])
                    line = np.searchsorted(breaks, words.start[a:b]) - first
                    heads = np.flatnonzero(np.diff(line, prepend=-1))
                    share = np.add.reduceat(total * hit[a:b], heads) / np.add.reduceat(total, heads)
                    ends = [*heads[1:], b - a]
                    for x in np.flatnonzero(share >= header * header / 4):
                        got = model.best(Counter(words.hash[a + heads[x] : a + ends[x]].tolist()))
                        if got and got[0] >= header and (best is None or (-round(got[0], 9), got[1]) < (-round(best[0], 9), best[1])):
                            best, line_no = got, int(line[heads[x]])
                    for x in range(*np.searchsorted(runs[3], [i, i + 1])):
                        # Best first: no later run can be better. The slack keeps ties.
                        if best is not None and runs[2][x] < best[0] - 1e-8:
                            break
                        got = model.best(Counter(words.hash[runs[0][x] : runs[1][x]].tolist()))
                        if got and got[0] >= header and (best is None or (-round(got[0], 9), got[1]) < (-round(best[0], 9), best[1])):
                            best, line_no = got, int(line[runs[0][x] - a])
                out.append((best and best[1], best and best[0], line_no, whole and whole[1], whole and whole[0]))
            columns = list(zip(*out))
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.string(), pa.float64())
            names = ["own_license", "own_score", "own_line", "whole_license", "whole_score"]
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], names=["row", *names])

    wanted = "row struct<{}>, own_license string, own_score double, own_line int, whole_license string, whole_score double"
    others = [c for c in files.columns if c != "text"]
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in files.select(*[F.col(f"`{c}`") for c in others]).schema)
    packed = files.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("text").cast("string").alias("text"))
    return packed.mapInArrow(scan, wanted.format(fields))


def _directory(path):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def license_scan(files: DataFrame, templates=TEMPLATES, *, header: float = HEADER, whole: float = WHOLE) -> DataFrame:
    """Every row of ``files`` without its text, with own_license, own_score, license and origin (``own``, ``inherited`` or null)."""
    model = Templates(templates, *frequencies(files, templates))
    found = materialize(own_licenses(files, model, header=header), "licenses")
    path = F.col("row.path")
    named = F.regexp_extract(path, r"([^/]*)$", 1).rlike(FILE_NAME) & F.col("own_license").isNotNull()
    full = F.col("whole_score") >= whole
    license_files = found.filter(named | full).select(
        _directory(path).alias("dir"), F.when(full & ~named, F.col("whole_license")).otherwise(F.col("own_license")).alias("license"),
        F.when(full & ~named, F.col("whole_score")).otherwise(F.col("own_score")).alias("score"), path.alias("path"),
    ).filter("dir IS NOT NULL")
    of_dir = license_files.groupBy("dir").agg(F.min(F.struct((-F.round("score", 9)).alias("s"), "path", "license")).alias("m")).select("dir", "m.license")

    # Inheritance is settled for directories, of which there are far fewer than files.
    dirs = found.select(_directory(path).alias("dir")).filter("dir IS NOT NULL").distinct()
    steps = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(1), F.size(steps))).alias("depth")).select(
        "dir", "depth", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/").alias("ancestor"))
    nearest = above.join(of_dir.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir").agg(F.max(F.struct("depth", "license")).alias("m"))
    inherited = nearest.select("dir", F.col("m.license").alias("from_dir"))
    joined = found.withColumn("dir", _directory(path)).join(inherited, "dir", "left")
    return joined.select(
        "row.*", "own_license", F.round("own_score", 6).alias("own_score"), F.coalesce("own_license", "from_dir").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(F.col("from_dir").isNotNull(), "inherited").alias("origin"),
    )


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / thousands of ids / hundreds of ids / file; the first twenty of a hundred ids are LICENSE files."""
    documents = read(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 100 < 20, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    folder = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string"))
    return license_scan(documents.select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text"))
