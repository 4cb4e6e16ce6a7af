"""Succession of old provisions by new ones: reading, checking and looking up the mapping table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids

#: Columns of a mapping file, relations, old codes with their successors.
COLUMNS = "old_code old_section new_code new_section relation heading change_note effective_date source verified".split()
RELATIONS = ("same", "modified", "split", "merged", "omitted", "unreviewed")
SUCCESSOR = {"IPC": "BNS", "CrPC": "BNSS"}
VALID_SECTION = r"^\d{1,3}[A-Z]{0,2}(?:\([0-9A-Za-z]{1,3}\))*$"


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping rows of CSV files; lines that begin with # are comments, empty fields are null."""
    raw = spark.read.option("header", True).option("comment", "#").option("enforceSchema", False).schema(", ".join(f"{c} string" for c in COLUMNS)).csv(path)
    return normalized(raw)


def normalized(raw: DataFrame) -> DataFrame:
    """Trimmed fields, one spelling of sections, ids of both provisions, typed date and flag."""
    f = {c: F.nullif(F.trim(c), F.lit("")) for c in COLUMNS}
    new_id = F.when(f["new_code"].isNotNull() & f["new_section"].isNotNull(), ids.statute_id(f["new_code"], f["new_section"]))
    return raw.select(
        f["old_code"].alias("old_code"), ids.section(f["old_section"]).alias("old_section"), f["new_code"].alias("new_code"),
        ids.section(f["new_section"]).alias("new_section"), f["relation"].alias("relation"), F.coalesce(f["heading"], F.lit("")).alias("heading"),
        f["change_note"].alias("change_note"), F.try_to_date(f["effective_date"], "yyyy-MM-dd").alias("effective_date"), F.coalesce(f["source"], F.lit("")).alias("source"),
        F.lower(F.coalesce(f["verified"], F.lit(""))).isin("yes", "true", "1").alias("verified"),
        ids.statute_id(f["old_code"], f["old_section"]).alias("old_id"), new_id.alias("new_id"),
    )


def violations(mapping: DataFrame) -> DataFrame:
    """(level, provision, rule) of every rule that a row or group of rows breaks."""
    missing = F.col("new_code").isNull() | F.col("new_section").isNull()
    omitted = F.col("relation") == "omitted"
    known = F.create_map(*[F.lit(x) for kv in SUCCESSOR.items() for x in kv])
    rules: list[tuple[str, Column]] = [
        ("old_code is unknown", ~F.col("old_code").isin(*SUCCESSOR)),
        ("relation is unknown", ~F.col("relation").isin(*RELATIONS)),
        ("old_section is no section number", ~F.col("old_section").rlike(VALID_SECTION)),
        ("an omitted provision names a successor", omitted & (F.col("new_code").isNotNull() | F.col("new_section").isNotNull())),
        ("an omitted provision needs a note", omitted & F.col("change_note").isNull()),
        ("a successor is required", ~omitted & missing),
        ("the successor is of another code", ~omitted & ~missing & (F.try_element_at(known, F.col("old_code")) != F.col("new_code"))),
        ("new_section is no section number", ~omitted & ~missing & ~F.col("new_section").rlike(VALID_SECTION)),
        ("a modified provision needs a note", (F.col("relation") == "modified") & F.col("change_note").isNull()),
        ("source is empty", F.col("source") == ""),
    ]
    broken = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(rule)) for rule, test in rules]))
    rows = mapping.select(F.lit("error").alias("level"), F.concat_ws(" ", "old_code", "old_section").alias("provision"), F.explode(broken).alias("rule"))
    twice = mapping.groupBy("old_id", "new_id").count().where("count > 1").select(F.lit("error"), "old_id", F.lit("duplicate row"))
    split = mapping.groupBy("old_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("relation") != "split").alias("k")).where("n > 1 AND k > 0")
    merged = mapping.where("new_id IS NOT NULL").groupBy("new_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("relation").isin("merged", "split")).alias("k")).where("n > 1 AND k > 0")
    flags = mapping.agg(F.count_if(~F.col("verified")).alias("u"), F.count_if(F.col("relation") == "unreviewed").alias("r"))
    parts = [
        rows,
        twice,
        split.select(F.lit("error"), "old_id", F.lit("several rows must all be split")),
        merged.select(F.lit("warning"), "new_id", F.lit("several provisions point here")),
        flags.where("u > 0").select(F.lit("warning"), F.col("u").cast("string"), F.lit("rows are not verified")),
        flags.where("r > 0").select(F.lit("warning"), F.col("r").cast("string"), F.lit("rows are unreviewed")),
    ]
    return reduce(lambda a, b: a.union(b), parts)


def lookup(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """refs(code, section, ...) with match (exact, base or none) and the successors in file order.

    The base section is used only where the exact one has no row at all. One join: both keys are put side by side and the
    better match of each provision is kept, so nothing is joined twice. The mapping is small by nature; it is grouped to one row a
    provision before the join, and Spark broadcasts it if its size allows.
    """
    rows = mapping.withColumn("at", F.monotonically_increasing_id()).groupBy("old_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "new_id"))), lambda x: x["new_id"]).alias("new_ids")
    )
    ids_ = refs.withColumn("exact_id", ids.statute_id(F.col("code"), F.col("section"))).withColumn("base_id", F.concat_ws(":", "code", ids.base_section(F.col("section"))))
    hit = ids_.join(rows.select(F.col("old_id").alias("exact_id"), F.col("new_ids").alias("exact_new")), "exact_id", "left").join(
        rows.select(F.col("old_id").alias("base_id"), F.col("new_ids").alias("base_new")), "base_id", "left"
    )
    match = F.when(F.col("exact_new").isNotNull(), "exact").when(F.col("base_new").isNotNull(), "base").otherwise("none")
    found = F.coalesce("exact_new", "base_new", F.array().cast("array<string>"))
    return hit.select(*refs.columns, match.alias("match"), F.array_distinct(F.array_compact(found)).alias("successors"))


def unmapped(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct provisions of the old codes that no row covers."""
    old = refs.where(F.col("code").isin(*SUCCESSOR)).select("code", "section").distinct()
    return lookup(old, mapping).where("match = 'none'").select(ids.statute_id(F.col("code"), F.col("section")).alias("statute_id"))
