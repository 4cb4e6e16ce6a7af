"""Passages taken in as files arrive: each micro-batch replaces the cases it brings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window


def latest_cases(batch: DataFrame, version: str = "loaded_at") -> DataFrame:
    """Of each case the rows of its latest load in the batch, one row a passage."""
    newest = F.max(version).over(Window.partitionBy("case_id"))
    kept = batch.where("case_id IS NOT NULL").withColumn("_v", newest).where(F.col(version).eqNullSafe(F.col("_v")) | (F.col("_v").isNull())).drop("_v")
    return kept.dropDuplicates(["chunk_id"])


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, buckets: int = 64, max_files: int = 100) -> StreamingQuery:
    """Stream parquet files of passages into a table partitioned by a bucket of the case.

    A bucket that a batch touches is written anew from its stored rows, without the cases that arrived, and the new ones; so a
    batch that is run again gives the same table. Only touched buckets are read.
    """

    def load(batch: DataFrame, _: int) -> None:
        new = latest_cases(batch).withColumn("case_bucket", F.pmod(F.xxhash64("case_id"), F.lit(buckets)).cast("int")).persist()
        touched = [r[0] for r in new.select("case_bucket").distinct().collect()]  # at most `buckets`
        if touched:
            try:
                old = spark.read.parquet(target).where(F.col("case_bucket").isin(*touched))
                new_cases = new.select("case_id").distinct()
                rows = old.join(new_cases, "case_id", "left_anti").unionByName(new)
            except Exception as e:  # the first batch has no table yet
                if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
                rows = new
            staged = rows.checkpoint()  # read before the partitions are overwritten
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("case_bucket").parquet(target)
        new.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events counted by type and time window; events later than `late` behind the newest are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("window.start", "window.end", "event_type", "n", "total")
