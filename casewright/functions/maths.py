"""Vectors and apportionment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Length of a vector; 1 for the zero vector."""
    n = F.sqrt(dot(a, a))
    return F.when(n == 0, 1.0).otherwise(n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def quotas(shares: DataFrame, key: str, share: str, total: int) -> DataFrame:
    """(key, quota): whole numbers that add up to total, the leftovers to the largest remainders; one row a key."""
    raw = F.lit(float(total)) * F.col(share)
    df = shares.select(key, F.floor(raw).alias("base"), (raw - F.floor(raw)).alias("rest"))
    all_ = Window.partitionBy(F.lit(1))  # one row a key
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("rest"), key))
    left = F.lit(total) - F.sum("base").over(all_)
    return df.withColumn("extra", (rank <= left).cast("long")).select(key, (F.col("base") + F.col("extra")).alias("quota"))
