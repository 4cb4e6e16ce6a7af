"""Vectors of texts, filtered exact search and its measures."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_vectors(df: DataFrame, key: str, text: str, size: int = 256) -> DataFrame:
    """(key, vector): counts of words hashed to `size` places by MD5, scaled to length 1. No words give the zero vector."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    place = F.pmod(F.conv(F.substring(F.md5(F.encode("word", "UTF-8")), 1, 8), 16, 10).cast("long"), F.lit(size)).cast("int")
    counts = df.select(key, F.explode(words).alias("word")).groupBy(key, place.alias("place")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sparse = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("m"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    full = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i) / F.col("norm"), F.lit(0.0)))
    return df.select(key).distinct().join(sparse, key, "left").select(key, F.coalesce(full, F.array_repeat(F.lit(0.0), size)).alias("vector"))


def filtered(points: DataFrame, statutes: list[str] | None = None, case_id: str | None = None, substantive_only: bool = True) -> DataFrame:
    """The points that a search may return: substantive ones (null counts as so), of one case, that cite one of some provisions
    under their old or new number. points(substantive, case_id, statutes, statutes_current); the filters reach the scan."""
    out = points.where(F.coalesce("substantive", F.lit(True))) if substantive_only else points
    if case_id is not None:
        out = out.where(F.col("case_id") == case_id)
    if statutes:
        asked = F.array(*[F.lit(s) for s in statutes])
        out = out.where(F.coalesce(F.arrays_overlap("statutes", asked), F.lit(False)) | F.coalesce(F.arrays_overlap("statutes_current", asked), F.lit(False)))
    return out


#: Bytes of queries that every worker holds for one scan of the points, and queries multiplied at once.
HELD_QUERIES, BLOCK = 64 << 20, 512


def nearest(points: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding", held: int = HELD_QUERIES) -> DataFrame:
    """(query_id, id, score, rank): for each query its k nearest points by cosine, ties by id.

    queries(query_id, query_vector) are sent to every worker up to a fixed number of bytes for one scan of the points (more queries
    take further scans); each partition of points multiplies matrices block by block and keeps its own k best of each
    query, so only k rows a query and partition are shuffled. Null vectors take no part; vectors of different lengths don't
    meet. Ids and query ids are of any type.
    """
    rows = queries.where("query_vector IS NOT NULL").select("query_id", "query_vector")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("query_vector")), F.lit(0))).first()
    scans = max(1, -(-int(size) // held))
    out = None
    for part in range(scans):
        mine = rows.where(F.pmod(F.xxhash64("query_id"), F.lit(scans)) == part) if scans > 1 else rows
        found = _scan(points, mine.collect(), k, id_, vector, rows)  # at most about the bytes held
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id_)
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _scan(points: DataFrame, mine: list, k: int, id_: str, vector: str, queries: DataFrame) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast([(r["query_id"], list(r["query_vector"])) for r in mine])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        by_size: dict[int, list] = {}
        for q, v in shared.value:
            by_size.setdefault(len(v), []).append((q, v))
        blocks = {}
        for size, asked in by_size.items():
            matrix = np.array([v for _, v in asked], np.float64)
            names = np.empty(len(asked), dtype=object)
            names[:] = [q for q, _ in asked]
            blocks[size] = names, matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
        for pdf in batches:
            sizes = np.array([-1 if v is None else len(v) for v in pdf[vector]], int)
            for size, (names, matrix) in blocks.items():
                mine = pdf[sizes == size]
                if not len(mine):
                    continue
                data = np.stack(mine[vector].to_numpy()).astype(np.float64)
                data /= np.maximum(np.linalg.norm(data, axis=1, keepdims=True), 1e-300)
                keys = mine[id_].to_numpy()
                for at in range(0, len(names), BLOCK):
                    score = np.round(matrix[at : at + BLOCK] @ data.T, 9)
                    top = np.lexsort((np.broadcast_to(keys, score.shape), -score), axis=1)[:, :k]
                    yield pd.DataFrame({"query_id": np.repeat(names[at : at + BLOCK], top.shape[1]), id_: keys[top].ravel(), "score": np.take_along_axis(score, top, 1).ravel()})

    kinds = dict(points.dtypes)
    return points.select(id_, vector).mapInPandas(run, f"query_id {dict(queries.dtypes)['query_id']}, {id_} {kinds[id_]}, score double")


def judged(hits: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """(question, wanted, first, got, wrong, seen): of each question the rank of its first right hit among k, how many hits it got,
    how many of them are of another case, and the cases of the first three.

    hits(question, rank, case_id, paragraph_num, para_end, opinion_index, doc_type); questions(question, case_id, paragraphs,
    opinion_index). A hit is right if it is a passage of the right case (and opinion, if given) and holds one of the
    paragraphs; where none are given, any judgment of the case will do.
    """
    q = questions.select("question", F.col("case_id").alias("wanted"), "paragraphs", F.col("opinion_index").alias("want_opinion"))
    top = hits.where(F.col("rank") <= k)
    none = F.coalesce(F.size("paragraphs"), F.lit(0)) <= 0
    holds = F.when(none, F.col("doc_type") == "judgment").otherwise(F.exists("paragraphs", lambda p: p.between(F.col("paragraph_num"), F.col("para_end"))))
    right = (F.col("case_id") == F.col("wanted")) & (F.col("want_opinion").isNull() | (F.col("want_opinion") == F.col("opinion_index"))) & holds
    seen = F.array_sort(F.collect_list(F.when(F.col("rank") <= 3, F.struct("rank", F.coalesce("case_id", F.lit("?")).alias("case")))))  # three a question
    return q.join(top, "question", "left").groupBy("question").agg(
        F.any_value("wanted").alias("wanted"),
        F.min(F.when(right, F.col("rank"))).alias("first"),
        F.count("rank").alias("got"),
        F.count_if(F.col("case_id") != F.col("wanted")).alias("wrong"),
        F.array_join(F.transform(seen, lambda x: x["case"]), ",").alias("seen"),
    )


def measures(hits: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """(questions, hit_at_k, mrr, drm_at_k) of hits and questions as for `judged`; without any the measures are 0."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return judged(hits, questions, k).agg(
        F.count(F.lit(1)).alias("questions"),
        F.round(F.count("first") / n, 6).alias("hit_at_k"),
        F.round(F.coalesce(F.sum(1.0 / F.col("first")), F.lit(0.0)) / n, 6).alias("mrr"),
        F.round(F.coalesce(F.sum("wrong") / F.greatest(F.sum("got"), F.lit(1)), F.lit(0.0)), 6).alias("drm_at_k"),
    )


def misses(hits: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """(question, wanted, got): the questions without a right hit among k, with the cases of the first hits or `nothing`."""
    return judged(hits, questions, k).where("first IS NULL").select("question", "wanted", F.when(F.col("seen") == "", "nothing").otherwise(F.col("seen")).alias("got"))


def keyword_search(df: DataFrame, text: str, words: list[str]) -> DataFrame:
    """Rows whose text holds all the words, in any order and case."""
    have = F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")
    cond = F.lit(True)
    for w in words:
        cond = cond & F.array_contains(have, w.lower())
    return df.where(cond)


def checked_size(points: DataFrame, vector: str, size: int) -> DataFrame:
    """The points, if all their vectors have the size of the collection; a ValueError names the other sizes."""
    other = [r[0] for r in points.where(F.col(vector).isNotNull() & (F.size(vector) != size)).select(F.size(vector).alias("n")).distinct().limit(5).collect()]
    if other:
        raise ValueError(f"vectors of {sorted(other)} places don't fit a collection of {size}")
    return points


def blocks_of(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """All passages(chunk_id, block_id, ...) of the blocks in which the hits(chunk_id) lie, each once."""
    blocks = passages.join(hits.select("chunk_id").distinct(), "chunk_id", "left_semi").select("block_id").distinct()
    return passages.join(blocks, "block_id", "left_semi")
