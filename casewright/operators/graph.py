"""The citation graph as node and edge tables, loaded case by case so that a load can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def duplicates(nodes: DataFrame, key: str) -> DataFrame:
    """Keys that stand more than once: none in a sound table."""
    return nodes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def replace_case(stored: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Stored rows with all rows of the cases in new replaced; columns by name."""
    return stored.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def upsert(stored: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """One row a key: the latest by version, of equal versions the new one. Null versions are the oldest."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    row = F.struct(*[F.col(c) for c in both.columns])
    latest = both.groupBy(key).agg(F.max_by(row, F.struct(F.coalesce(F.col(version).cast("string"), F.lit("")), "_new")).alias("r"))
    return latest.select(*[F.col(f"r.{c}").alias(c) for c in stored.columns])


def bench_edges(cases: DataFrame) -> DataFrame:
    """(case_id, judge_id, name): a judge heard a case; names without letters are left out, several spellings of one id are one edge."""
    flat = cases.select("case_id", F.explode("bench").alias("name"))
    flat = flat.withColumn("judge_id", ids.judge_slug(F.col("name"))).where("judge_id <> ''")
    return flat.groupBy("case_id", "judge_id").agg(F.min("name").alias("name"))


def author_edges(opinions: DataFrame) -> DataFrame:
    """(case_id, opinion_index, judge_id, type): one edge an opinion; opinions without an author have none."""
    rows = opinions.select("case_id", "opinion_index", ids.judge_slug(F.col("author")).alias("judge_id"), F.col("opinion_type").alias("type"))
    return rows.where("judge_id <> ''").distinct()


def resolve(citing: DataFrame, cases: DataFrame) -> DataFrame:
    """(case_id, target, stub, paragraphs, keys): cited cases resolved to loaded ones by any of their citation keys.

    citing(case_id, keys, paragraphs); cases(case_id, keys). The loaded case of the first key that has one is the target, of several the
    least case_id; without one the target is a stub named by the first key. References of a case to itself are left out,
    those to one target are merged with sorted paragraphs. Equal inputs resolve equally in any order of loading.
    """
    known = cases.select(F.col("case_id").alias("found"), F.explode("keys").alias("key")).groupBy("key").agg(F.min("found").alias("found"))
    rows = citing.where(F.size("keys") > 0).withColumn("ref", F.xxhash64("case_id", F.array_join("keys", "|")))
    hits = rows.select("case_id", "ref", F.posexplode("keys").alias("pos", "key")).join(known, "key").groupBy("case_id", "ref").agg(F.min_by("found", "pos").alias("found"))
    named = rows.join(hits, ["case_id", "ref"], "left")
    target = F.coalesce("found", F.concat(F.lit("cite:"), F.col("keys")[0]))
    merged = named.withColumn("target", target).where("target <> case_id").groupBy("case_id", "target").agg(
        F.max(F.col("found").isNull()).alias("stub"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("paragraphs")))).alias("paragraphs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"),
    )
    return merged


def absorb(edges: DataFrame, cases: DataFrame) -> DataFrame:
    """Edges whose stub targets are now loaded cases point to these, merged with edges that did already."""
    known = cases.select(F.explode("keys").alias("key"), "case_id").groupBy("key").agg(F.min("case_id").alias("found"))
    moved = edges.join(known.withColumn("target", F.concat(F.lit("cite:"), "key")).select("target", "found"), "target", "left")
    moved = moved.withColumn("target", F.coalesce("found", "target")).where("target <> case_id")
    return moved.groupBy("case_id", "target").agg(
        F.min(F.col("stub") & F.col("found").isNull()).alias("stub"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("paragraphs")))).alias("paragraphs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"),
    )


def overrules(edges: DataFrame, overruled: DataFrame) -> DataFrame:
    """(case_id, target) of cited cases that the case's record names as overruled; overruled(case_id, key)."""
    wide = edges.select("case_id", "target", F.explode("keys").alias("key"))
    return wide.join(overruled, ["case_id", "key"], "left_semi").select("case_id", "target").distinct()


def succession(mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, omitted): replaced_by edges of the mapping, and old provisions without a successor."""
    title = F.when(F.col("heading") != "", F.col("heading"))
    edges = mapping.where("new_id IS NOT NULL").select("old_id", "new_id", "relation", title.alias("title"), "change_note", "effective_date", "verified")
    return edges, mapping.where("new_id IS NULL").select("old_id", title.alias("title"), "change_note")


def statute_nodes(mentions: DataFrame, mapping: DataFrame) -> DataFrame:
    """(statute_id, title, in_mapping): provisions mentioned or mapped; a mapping row names the provision."""
    mapped = mapping.select(F.col("old_id").alias("statute_id"), F.nullif("heading", F.lit("")).alias("title")).unionByName(
        mapping.where("new_id IS NOT NULL").select(F.col("new_id").alias("statute_id"), F.nullif("heading", F.lit("")).alias("title"))
    )
    said = mentions.select("statute_id", F.lit(None).cast("string").alias("title"))
    both = mapped.withColumn("m", F.lit(True)).unionByName(said.withColumn("m", F.lit(False)))
    return both.groupBy("statute_id").agg(F.min("title").alias("title"), F.max("m").alias("in_mapping"))


def node_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(label, n) of node tables given as name: (table, key)."""
    parts = [df.agg(F.count_distinct(key).alias("n")).select(F.lit(name).alias("label"), "n") for name, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alerts(provisions: DataFrame, mapping: DataFrame, active: Column) -> DataFrame:
    """(statute_id, ..., new_id): the provisions that are no longer in force, each with its successors, or null where it has none.

    provisions(statute_id, ...); mapping(old_id, new_id).
    """
    follow = mapping.select(F.col("old_id").alias("statute_id"), "new_id").distinct()
    return provisions.where(~active).join(follow, "statute_id", "left")


def edges_around(edges: DataFrame, case_id: str, source: str = "case_id", target: str = "target") -> DataFrame:
    """The edges that begin or end at one case."""
    return edges.where((F.col(source) == case_id) | (F.col(target) == case_id))
