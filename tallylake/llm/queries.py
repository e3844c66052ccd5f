"""All queries of this subpackage; importing the modules registers them."""

from __future__ import annotations

from tallylake.llm import (  # noqa: F401
    alignment, chat, covertree, decontaminate, jaccard, katz, licenses, packing, quality, tokenfiles, topk, toxicity, urls,
)
from tallylake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
