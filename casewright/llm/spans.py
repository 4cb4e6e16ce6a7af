"""P7: passages of at least a given length that stand word for word in several records.

MinHash banding over passages: the passages of a text are all its windows of `least` characters. A passage's MinHash is
the least hash of its short character runs (the anchor); equal passages have equal minima, so one row a band is enough for
full recall. Two bands are kept for each anchor: the anchor with the text on its right, and with the text on its left; a
shared passage covers at least one of them. Only the anchors whose band collides with that of another text go on, with the
piece of text their windows cover; texts themselves are never shuffled. Their windows are compared by 128-bit hashes of
all characters, which takes work in proportion to the pieces however many texts share a passage. Pairs are formed only
where they are the result, and verified by comparing characters. Identical texts are compared once, as a class.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import checkpointed, fits, table, written

LEAST = 200
RUN = 32
SEGMENT = 400_000
#: Rows of a band that are joined in one task; a band with more is split over as many tasks as it has such parts.
HOT = 512
#: Colliding bands that every worker holds, at most; more are joined.
HELD = 4_000_000
BASE = 0x9E3779B97F4A7C15 | 1


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Hashes of all runs of a string by prefix sums modulo 2**64."""

    def __init__(self, size: int):
        import numpy as np

        inverse = pow(BASE, -1, 1 << 64)
        self.up = np.empty(size + 1, np.uint64)
        self.down = np.empty(size + 1, np.uint64)
        self.up[0] = self.down[0] = 1
        self.up[1:], self.down[1:] = BASE, inverse
        np.multiply.accumulate(self.up, out=self.up)
        np.multiply.accumulate(self.down, out=self.down)

    def sums(self, codes):
        import numpy as np

        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.up[: len(codes)], out=out[1:])
        return out

    def hashes(self, sums, starts, length: int):
        return (sums[starts + length] - sums[starts]) * self.down[starts]


def anchors_of(codes, ids, starts, w: Windows, least: int, run: int):
    """Anchors of the texts that lie one behind the other in codes, as arrays: text number, offset, first and last window
    that has this anchor, and the keys of both bands with masks that tell whether they exist."""
    import numpy as np

    n, width = len(codes), least - run + 1
    sums = w.sums(codes)
    at = np.arange(n - run + 1)
    low = _mix(w.hashes(sums, at, run))
    ranked = (low & np.uint64(0xFFFFFFFFFF000000)) | at.astype(np.uint64)
    pad = -len(ranked) % width + width
    padded = np.concatenate([ranked, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    first = np.arange(n - least + 1)
    first = first[ids[first] == ids[first + least - 1]]  # windows within one text
    chosen = (np.minimum(right[first], left[first + width - 1]) & np.uint64(0xFFFFFF)).astype(np.int64)
    begin = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    picked = chosen[begin]
    first_window, last_window = first[begin], first[np.append(begin[1:], len(first)) - 1]
    half = (width - 1) // 2
    size = run + half
    owner = ids[picked]
    ends = np.append(starts[1:], n)
    keys = []
    for band, start in ((0, picked), (1, picked - half)):
        ok = (start >= starts[owner]) & (start + size <= ends[owner])
        key = np.zeros(len(picked), np.int64)
        key[ok] = _mix(w.hashes(sums, start[ok], size) + np.uint64(band)).view(np.int64)
        keys.append((key, ok))
    return owner, picked - starts[owner], first_window - starts[owner], last_window - starts[owner], keys


def _each_part(batches: Iterator, least: int, run: int) -> Iterator:
    """(texts, places, anchors) of parts of about SEGMENT characters: place is (row, offset of the part in its text)."""
    import numpy as np

    windows = Windows(2 * SEGMENT + 4 * least)
    parts, total = [], 0

    def flush():
        codes = np.concatenate([c for _, _, c in parts])
        size = np.array([len(c) for _, _, c in parts])
        starts = np.cumsum(size) - size
        return [(r, o) for r, o, _ in parts], anchors_of(codes, np.repeat(np.arange(len(parts)), size), starts, windows, least, run)

    for pdf in batches:
        for row in pdf.itertuples(index=False):
            codes = np.frombuffer(row.text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            for s in range(0, max(1, len(codes) - 2 * least), SEGMENT):
                part = codes[s : s + SEGMENT + 2 * least]
                parts.append((row, s, part))
                total += len(part)
                if total >= SEGMENT:
                    yield flush()
                    parts.clear()
                    total = 0
    if parts:
        yield flush()


def colliding_bands(texts: DataFrame, least: int = LEAST, run: int = RUN) -> DataFrame:
    """(key): the bands in which different texts collide. texts(h, text), h a 64-bit hash of the text."""

    def go(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for places, (own, _, _, _, keys) in _each_part(batches, least, run):
            h = np.array([r.h for r, _ in places], np.int64)[own]
            yield pd.DataFrame({"key": np.concatenate([k[ok] for k, ok in keys]), "h": np.concatenate([h[ok] for _, ok in keys])})

    each = texts.select("h", "text").mapInPandas(go, "key long, h long")
    both = each.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("z"))
    return checkpointed(both.where("a <> z").select("key"))


PIECE = "tid binary, pos int, at int, right long, left long, begin int, size int, piece string"


def colliding_pieces(texts: DataFrame, keys: DataFrame, least: int = LEAST, run: int = RUN, held: int = HELD) -> DataFrame:
    """(tid, pos, at, right, left, piece): anchors with a colliding band, once a text: the piece of text that the anchor's windows
    cover, where the anchor lies in it, and the colliding bands (null where a band doesn't collide).

    texts(tid, text). The keys are held by every worker up to `held`, and joined beyond.
    """
    small = fits(keys, held, 8 * held, F.lit(8))
    shared = texts.sparkSession.sparkContext.broadcast(sorted(r[0] for r in keys.collect())) if small else None

    def go(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        known = np.array(shared.value, np.int64) if small else None
        for places, (own, pos, a, z, bands) in _each_part(batches, least, run):
            hit = []
            for key, ok in bands:
                if known is not None:
                    at = np.searchsorted(known, key)
                    ok = ok & (at < len(known))
                    ok[ok] = known[at[ok]] == key[ok]
                hit.append(ok)
            keep = np.flatnonzero(hit[0] | hit[1])
            if not len(keep):  # columns of no rows are no strings to Arrow
                continue
            rows = []
            for i in keep.tolist():
                row, offset = places[own[i]]
                begin, size = offset + int(a[i]), int(z[i] - a[i]) + least
                rows.append((row.tid, offset + int(pos[i]), int(pos[i] - a[i]), *(int(k[i]) if h[i] else None for (k, _), h in zip(bands, hit, strict=True)), begin, size, row.text[begin : begin + size] if small else None))
            names = [x.split()[0] for x in PIECE.split(", ")]
            columns = dict(zip(names, zip(*rows, strict=True), strict=True))
            yield pd.DataFrame({n: pd.array(c, "Int64") if n in ("right", "left") else list(c) for n, c in columns.items()})

    found = texts.select("tid", "text").mapInPandas(go, PIECE)
    if not small:
        side = lambda name: found.join(keys.select(F.col("key").alias(name)), name, "left_semi").select("tid", "pos", "at", F.col(name), "begin", "size").distinct()
        met = side("right").join(side("left"), ["tid", "pos", "at", "begin", "size"], "full_outer")
        once = texts.dropDuplicates(["tid"])
        found = met.join(once, "tid").withColumn("piece", F.substring("text", F.col("begin") + 1, F.col("size")))
    # few bytes but much work behind: spread by number, which adaptive execution leaves alone
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(found.select("tid", "pos", "at", "right", "left", "piece").repartition(spread, "tid", "pos").dropDuplicates(["tid", "pos", "at", "piece"]))


def common(a: Column, b: Column) -> Column:
    """Length of the common beginning of two strings of fewer than 256 characters, by halving steps."""
    return F.aggregate(
        F.array(*[F.lit(1 << k) for k in range(7, -1, -1)]),
        F.lit(0),
        lambda n, s: F.when(
            (n + s <= F.least(F.length(a), F.length(b))) & (F.substring(a, n + 1, s) == F.substring(b, n + 1, s)), n + s
        ).otherwise(n),
    )


class Shared:
    """What the distinct texts of df share: pieces, the shared windows in them, and the members (tid, id) of each text.

    Null ids, null texts and texts below `least` characters take no part; repeated rows count once.
    """

    def __init__(self, df: DataFrame, key: str, text: str, least: int = LEAST, run: int = RUN, held: int = HELD):
        self.least = least
        rows = df.select(F.col(key).alias("id"), F.col(text).alias("text")).where(F.col(key).isNotNull() & (F.length(text) >= least))
        rows = rows.select("id", "text", F.unhex(F.md5("text")).alias("tid"))
        self.members = rows.select("tid", "id").distinct()
        keys = colliding_bands(rows.select(F.xxhash64("tid").alias("h"), "text"), least, run)
        self.pieces = colliding_pieces(rows.select("tid", "text"), keys, least, run, held)
        half = (least - run) // 2
        # windows that hold a colliding band: those with the anchor in the first half, or in the second
        low = F.when(F.col("left").isNotNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.col("at") - half))
        last = F.length("piece") - least
        high = F.when(F.col("right").isNotNull(), last).otherwise(F.least(last, F.col("at") - half))
        windows = self.pieces.where(low <= high).select("tid", "pos", "at", "piece", F.explode(F.sequence(low, high)).alias("k"))
        windows = windows.select("tid", "pos", (F.col("pos") - F.col("at") + F.col("k")).alias("start"), F.unhex(F.md5(F.substring("piece", F.col("k") + 1, F.lit(least)))).alias("window"))
        # one shuffle of the windows: each is told from the others of its hash where they meet
        same = Window.partitionBy("window")
        met = windows.withColumn("a", F.min(F.xxhash64("tid")).over(same)).withColumn("z", F.max(F.xxhash64("tid")).over(same)).where("a <> z")
        self.windows = checkpointed(met.select("window", "tid", "pos", "start"))

    def pairs(self) -> DataFrame:
        """(tid_a, tid_b), tid_a < tid_b: texts that share a passage; only anchors with a shared window are joined."""
        live = self.pieces.join(self.windows.select("tid", "pos").distinct(), ["tid", "pos"])
        rows = live.select("tid", "at", "piece", F.explode(F.array_compact(F.array("right", "left"))).alias("key"))
        parts = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("long").alias("parts"))
        near = rows.join(parts, "key").select(
            "key", "parts", "tid", F.reverse(F.substring("piece", F.lit(1), F.col("at"))).alias("left"), F.substring("piece", F.col("at") + 1, F.length("piece")).alias("right")
        )
        a = near.select("key", F.pmod(F.xxhash64("tid", "left"), "parts").alias("part"), *[F.col(c).alias(f"{c}_a") for c in ("tid", "left", "right")])
        b = near.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), *[F.col(c).alias(f"{c}_b") for c in ("tid", "left", "right")])
        same = common(F.col("left_a"), F.col("left_b")) + common(F.col("right_a"), F.col("right_b"))
        return a.join(b, ["key", "part"]).where("tid_a < tid_b").where(same >= self.least).select("tid_a", "tid_b").distinct()


def sharing_pairs(df: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records with different ids whose texts share a run of `least` characters.

    Pairs of texts are found between distinct texts; records with the same text are put in at the end. Null texts and
    ids take no part; repeated rows count once; an empty table gives no rows.
    """
    found = Shared(df, key, text, least)
    a = found.members.select(F.col("tid").alias("tid_a"), F.col("id").alias("x"))
    b = found.members.select(F.col("tid").alias("tid_b"), F.col("id").alias("y"))
    across = found.pairs().join(a, "tid_a").join(b, "tid_b").where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    within = a.join(b.withColumnRenamed("tid_b", "tid_a"), "tid_a").where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(within).distinct()


def shared_share(df: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """(id, length, shared_chars, share): how much of each record's text stands in a record with another text, or in
    another record with the same text. Texts below `least` characters and null texts have share 0. No pairs are formed.
    """
    found = Shared(df, key, text, least)
    order = Window.partitionBy("tid").orderBy("start")  # the windows of one text
    step = F.col("start") - F.lag("start").over(order)
    covered = found.windows.select("tid", F.least(F.lit(least), F.coalesce(step, F.lit(least))).alias("n")).groupBy("tid").agg(F.sum("n").alias("n"))
    copies = found.members.groupBy("tid").agg(F.count(F.lit(1)).alias("copies"))
    part = found.members.join(copies, "tid").join(covered, "tid", "left")
    part = part.groupBy("id").agg(F.max("copies").alias("copies"), F.max("n").alias("n"))
    rows = df.select(F.col(key).alias("id"), F.length(text).alias("length")).where(F.col(key).isNotNull()).groupBy("id").agg(F.max("length").alias("length"))
    n = F.when(F.col("copies") > 1, F.col("length")).otherwise(F.coalesce("n", F.lit(0)).cast("int"))
    return rows.join(part, "id", "left").select(
        "id", "length", n.alias("shared_chars"), F.round(F.coalesce(n / F.when(F.col("length") > 0, F.col("length")), F.lit(0.0)), 4).alias("share")
    )


def passage_classes(df: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """(id, class_id, links): connected components of the sharing records with the number of other texts each is linked to.

    Each text is linked to one representative of every window it shares, so no pairs are formed; labels spread by the least neighbour
    and jump through labels until none moves. Windows that the same texts share count as one passage: a text with one
    passage has as many links as that has other texts, and only texts with several passages are held against those
    passages' texts. Records that share nothing are their own class with no links.
    """
    found = Shared(df, key, text, least)
    on = found.windows.select("window", "tid").distinct()
    passages = on.groupBy("window").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("tid").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("tid")).alias("xor"), F.min("tid").alias("least"))
    passage = F.struct("size", "sum", "xor").alias("passage")
    held = checkpointed(on.join(passages, "window").select("tid", passage, F.hex("least").alias("least")).distinct())
    edges = written(held.select(F.hex("tid").alias("u"), F.col("least").alias("v")).where("u <> v").distinct())
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = written(both.select("u", F.col("u").alias("label")).distinct())
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        stepped = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("u").alias("next"), F.col("label").alias("far"))
        new = written(stepped.join(jump, "next").select("u", F.least("next", "far").alias("label"), (F.col("label") != F.least("next", "far")).alias("moved")))
        labels = new.select("u", "label")
        if new.where("moved").isEmpty():
            break
    of = held.select("tid", "passage").distinct()
    number = of.groupBy("tid").agg(F.count(F.lit(1)).alias("passages"), F.max("passage.size").alias("size"))
    single = number.where("passages = 1").select("tid", (F.col("size") - 1).alias("links"))
    several = of.join(number.where("passages > 1").select("tid"), "tid").join(of.select("passage", F.col("tid").alias("other")), "passage").where("tid <> other")
    degree = single.unionByName(several.select("tid", "other").distinct().groupBy("tid").agg(F.count(F.lit(1)).alias("links")))
    ids = df.select(F.col(key).alias("id")).where(F.col(key).isNotNull()).distinct()
    named = found.members.withColumn("u", F.hex("tid")).join(labels, "u", "left").join(degree, "tid", "left")
    named = named.groupBy("id").agg(F.min(F.coalesce("label", "u")).alias("class_id"), F.max(F.coalesce("links", F.lit(0))).alias("links"))
    return ids.join(named, "id", "left").select("id", F.coalesce("class_id", F.concat(F.lit("id:"), "id")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = sharing_pairs(table(spark, sf_dir, "chunks"), "chunk_id", "text")
    return pairs.select(F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each chunk's text found elsewhere, beside its quoted share."""
    chunks = table(spark, sf_dir, "chunks")
    quoted = chunks.groupBy(F.col("chunk_id").alias("id")).agg(F.max("quoted_share").alias("quoted_share"))
    return shared_share(chunks, "chunk_id", "text").join(quoted, "id").withColumnRenamed("id", "chunk_id")


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of each chunk and its number of links."""
    return passage_classes(table(spark, sf_dir, "chunks"), "chunk_id", "text").withColumnRenamed("id", "chunk_id")
