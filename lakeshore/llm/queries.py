"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from ..session import ship_package
from . import (chat, fingerprints, html, jaccard, langid, merkle, mixing, packing, repair, tokenfiles, topk, toxicity,
               wordpiece)

MODULES = (mixing, fingerprints, chat, packing, langid, html, wordpiece, jaccard, topk, toxicity, repair, tokenfiles,
           merkle)


def _shipped(fn):
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict:
    return {name: _shipped(fn) for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLES", {}).items()}
