"""Medallion (bronze / silver / gold) data pipelines as Spark DataFrame operators.

Every operator takes and returns DataFrames, works on many files at once and
keeps its per-file rules keyed by the file columns of the bronze layer.
"""
