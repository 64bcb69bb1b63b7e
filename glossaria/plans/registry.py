"""All queries of the core and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ["references", "corpus", "lexicon", "judgements", "paradigms", "warehouse", "streams", "articles", "package"]


def _all(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"glossaria.plans.{name}"), what)
        if twice := out.keys() & part.keys():
            raise ValueError(f"query names used twice: {sorted(twice)}")
        out |= part
    return out


def queries() -> dict[str, Query]:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLE")
