"""All queries of the subpackage, by importing the modules that register them."""

from __future__ import annotations

import importlib

from tierline.llm.common import QUERIES, SQL

for _module in ("bit_sliced", "chat", "collocations", "decontamination", "html_text", "language", "licenses", "near_dedup", "packing", "secrets", "spelling", "suffixes", "token_files"):
    importlib.import_module(f"tierline.llm.{_module}")

__all__ = ["QUERIES", "SQL"]
