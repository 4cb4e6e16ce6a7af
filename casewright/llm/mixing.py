"""P9: documents of several sources combined to target shares of tokens, small sources repeated a limited number of times.

Distinct texts are grouped by the set of sources they stand in (their membership pattern). A min-cost flow routes the
patterns' tokens to the sources' quotas: the first use of a text is free and each further use costs one more, so
repetition is the last resort and is spread evenly. The total is the largest for which all quotas can be filled. The
flow is then laid out along each pattern's documents in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import checkpointed, one_per_key, table
from .bpe import TOKENIZERS, token_counts

SEED = 20260
ROWS_A_BUCKET = 5000


class Flow:
    """Min-cost flow by successive shortest paths; the graph has a few hundred arcs."""

    def __init__(self, nodes: int):
        self.arcs: list[list] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, start: int, end: int) -> int:
        """Send as much as possible at least cost; the amount sent."""
        total = 0
        while True:
            far = [float("inf")] * len(self.out)
            far[start], via = 0, [-1] * len(self.out)
            moved = True
            while moved:
                moved = False
                for a, arcs in enumerate(self.out):
                    if far[a] == float("inf"):
                        continue
                    for k in arcs:
                        b, capacity, cost = self.arcs[k]
                        if capacity > 0 and far[a] + cost < far[b]:
                            far[b], via[b], moved = far[a] + cost, k, True
            if via[end] < 0:
                return total
            path, at = [], end
            while at != start:
                path.append(via[at])
                at = self.arcs[via[at] ^ 1][0]
            amount = min(self.arcs[k][1] for k in path)
            for k in path:
                self.arcs[k][1] -= amount
                self.arcs[k ^ 1][1] += amount
            total += amount


def _route(sizes: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int) -> dict | None:
    """Tokens of each pattern for each source at a given total; None if a quota can't be filled."""
    patterns, names = sorted(sizes), sorted(shares)
    flow = Flow(2 + len(patterns) + len(names))
    quota = {s: int(shares[s] * total) for s in names}
    sink = 1 + len(patterns) + len(names)
    routes = {}
    for i, p in enumerate(patterns, 1):
        for level in range(min(repeats[s] for s in p)):
            flow.add(0, i, sizes[p], level)
        for s in p:
            routes[p, s] = flow.add(i, 1 + len(patterns) + names.index(s), min(repeats[x] for x in p) * sizes[p], 0)
    for j, s in enumerate(names):
        flow.add(1 + len(patterns) + j, sink, quota[s], 0)
    if flow.run(0, sink) < sum(quota.values()):
        return None
    return {k: flow.arcs[a ^ 1][1] for k, a in routes.items()}


def plan(sizes: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int | None = None) -> tuple[int, dict]:
    """(total, tokens of each pattern for each source); the total is the largest that can be filled, or the given one if
    it is smaller."""
    low, high = 0, sum(n * max(repeats[s] for s in p) for p, n in sizes.items())
    if total is not None:
        high = min(high, total)
    if _route(sizes, shares, repeats, high) is not None:
        low = high
    while high - low > max(1, high // 100_000):
        middle = (low + high) // 2
        if _route(sizes, shares, repeats, middle) is None:
            high = middle
        else:
            low = middle
    return low, _route(sizes, shares, repeats, low) or {}


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, source, tokens, uses): the documents of the mix with the number of times each is used.

    docs(doc_id, text, source); targets(source, target_share, max_repeats). A text that stands under several ids is one
    document, named by its least id in the source it is used for; a text in several sources is used at most as often as
    the strictest of them allows. Sources without a target, null and empty texts and null sources are left out. A target
    source without usable tokens can't be filled: the others keep their proportions, and `shares_reached` reports the
    shortfall. A use that begins within a quota is kept whole, so
    a source may exceed its quota by less than one document for each pattern.
    """
    wanted = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in one_per_key(targets, "source").collect()}  # one row a source
    shares = {s: x for s, (x, _) in wanted.items() if x > 0}
    repeats = {s: max(0, n) for s, (_, n) in wanted.items()}
    wide = docs.where(F.col("source").isin(*shares) & (F.length("text") > 0)).select(F.struct("doc_id", "source", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("key")).alias("place"), "text")
    # texts stay where they lie: only their hash and number of tokens go on
    used = checkpointed(token_counts(wide, "place", "text", path).select("place.*", "tokens").groupBy("key", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens")))
    items = used.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("source")), "\n").alias("pattern"), F.max("tokens").alias("tokens")).where("tokens > 0")
    sizes = {tuple(r[0].split("\n")): int(r[1]) for r in items.groupBy("pattern").agg(F.sum("tokens")).collect()}  # at most 2 ** sources
    usable = {p: n for p, n in sizes.items() if min(repeats[s] for s in p) > 0}
    filled = {s for p in usable for s in p}
    rest = sum(x for s, x in shares.items() if s in filled)
    _, routes = plan(usable, {s: x / rest for s, x in shares.items() if s in filled}, repeats, total)
    spark = docs.sparkSession
    cuts = []
    for p in sizes:
        at = 0
        for s in p:
            if (n := routes.get((p, s), 0)) > 0:
                cuts.append(("\n".join(p), s, at, at + n, sizes[p], min(repeats[x] for x in p)))
                at += n
    cut = spark.createDataFrame(cuts, "pattern string, source string, from long, to long, size long, levels int")

    buckets = max(16, items.count() // ROWS_A_BUCKET)
    order = F.xxhash64(F.lit(seed), "key")
    placed = items.withColumn("h", order).withColumn("bucket", F.floor((F.col("h") / 2.0 + float(1 << 62)) / float(1 << 63) * buckets).cast("long"))
    sums = placed.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over buckets
    sums = sums.withColumn("base", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    within = Window.partitionBy("pattern", "bucket").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inner", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(sums, ["pattern", "bucket"])
    uses = (
        placed.select("key", "pattern", "tokens", (F.col("base") + F.col("inner")).alias("at"))
        .join(F.broadcast(cut), "pattern")  # at most sources * 2 ** sources rows
        .select("key", "source", "tokens", "from", "to", F.explode(F.transform(F.sequence(F.lit(0), F.col("levels") - 1), lambda k: k * F.col("size") + F.col("at"))).alias("start"))
        .where((F.col("start") >= F.col("from")) & (F.col("start") < F.col("to")))
        .groupBy("key", "source", "tokens")
        .agg(F.count(F.lit(1)).cast("int").alias("uses"))
    )
    return uses.join(used.select("key", "source", "doc_id"), ["key", "source"]).select("doc_id", "source", "tokens", "uses")


def shares_reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, shortfall, tokens, documents, max_repeats, most_uses) of each target; sources without
    documents have share 0 and their whole target as shortfall."""
    by = mixed.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("most_uses")
    )
    every = one_per_key(targets, "source").join(by, "source", "left").fillna(0, ["tokens", "documents", "most_uses"])
    all_ = Window.partitionBy(F.lit(1))  # one row a source
    share = F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(all_), F.lit(0)), F.lit(0.0))
    short = F.round(F.greatest(F.lit(0.0), F.col("target_share") - share), 6)
    return every.select("source", "target_share", F.round(share, 6).alias("share"), short.alias("shortfall"), "tokens", "documents", "max_repeats", "most_uses")


def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached beside the targets."""
    targets = table(spark, sf_dir, "mix_targets")
    return shares_reached(mix(table(spark, sf_dir, "documents"), targets), targets)
