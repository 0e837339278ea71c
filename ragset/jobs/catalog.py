"""The registered queries of the reference's own operators and their SQL."""

from __future__ import annotations

import importlib
import re

MODULES = ["corpus", "retrieval", "replies", "dedup", "metrics"]
NAME = re.compile(r"[a-z]\d+_\w+")


def _modules():
    return [importlib.import_module(f"ragset.jobs.{m}") for m in MODULES]


def queries():
    return {n: f for m in _modules() for n, f in vars(m).items() if NAME.fullmatch(n) and getattr(f, "__module__", "") == m.__name__}


def oracle_sql():
    return {n: q for m in _modules() for n, q in m.SQLS.items()}


def flagship(spark, sf_dir):
    """Windows of all documents, their statistics by source, and the total."""
    return queries()["p4_datasets_total"](spark, sf_dir)
