"""Sinks: passages as JSON lines, reports as CSV, cases replaced partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx


def export_lines(passages: DataFrame, path: str) -> None:
    """Passages that are not rejected, one JSON object a line, with point id and the text to embed. Only the first of rows with
    one chunk_id is written."""
    out = passages.where(F.coalesce(F.col("parse_quality"), F.lit("ok")) != "reject").dropDuplicates(["chunk_id"])
    out = out.withColumn("id", ids.point_id(F.col("chunk_id"))).withColumn("embedding_text", tx.embedding_text(F.col("context"), F.col("text")))
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def report(verdicts: DataFrame, path: str, columns: list[str]) -> None:
    """A report in the given columns, with a header."""
    verdicts.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def replace_cases(rows: DataFrame, path: str, key: str = "case_bucket") -> None:
    """Overwrite only the partitions of the key that rows hold; other partitions stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
