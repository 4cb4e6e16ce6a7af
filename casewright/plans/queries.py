"""Queries of the core, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("casewright.operators.reconcile", "casewright.plans.functions_q", "casewright.plans.relational_q", "casewright.plans.documents_q")


def _modules() -> list:
    return [importlib.import_module(m) for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
