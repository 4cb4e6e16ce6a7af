"""Queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("names", "encoding", "split", "lookalikes", "scans", "spans", "bpe", "mixing", "languages")


def _modules() -> list:
    return [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for m in _modules() for n, f in vars(m).items() if n[:1] == "p" and n[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in getattr(m, "ORACLES", {}).items()}
