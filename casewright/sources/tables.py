"""Readers of the parquet tables and small helpers shared by all operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; columns are pruned by Catalyst."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop repeated rows: one row per key, with hash aggregation on the key alone.

    Repeated rows have equal content, so any of them stands for all. Rows whose key is null are dropped.
    """
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond).dropDuplicates(list(keys))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, set as Spark's checkpoint folder.

    A temporary folder is set only where none is named (local tests).
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
            import tempfile

            folder = f"{tempfile.gettempdir()}/casewright-{uuid.uuid4().hex}"
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the checkpoint folder, for loops: a checkpoint hands its plan's constraints on, which
    grow with every round, and its size isn't known to the planner."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int, max_bytes: int, size: Column) -> bool:
    """Whether df is at most max_rows rows and max_bytes bytes (size: bytes of a row); one small aggregate."""
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and b <= max_bytes
