"""P1: spellings of people's names linked to the register's person they mean.

Distinct spellings and register names become vectors of weighted character n-grams. Sparse joins over shared n-grams give
each spelling its most similar register names and its most similar other spellings (top n by cosine above a threshold). A
register name must also agree part by part (surname with typing errors, given names in full, short or as initial, in any
usual order). Spellings that may mean the same person are grouped by average linkage: rounds merge the pairs of groups that
are each other's nearest, while the mean cosine of all their pairs is high enough. Where the parts leave several persons, a
group goes to the one of them to whom its spellings have the largest mean cosine, if that leads clearly.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.tables import checkpointed, fits, one_per_key, table, written

#: Nearest register names that are tried first, and their least cosine; spellings that fit none of them are tried with all.
TOP, LEAST_COSINE = 12, 0.12
#: Nearest other spellings of a spelling, their least cosine, the least mean cosine at which groups merge, and the lead that
#: a person needs before the next one.
NEAREST, ALIKE, LEAST_LINKAGE, LEAD = 8, 0.6, 0.35, 0.02
#: Cost of all parts together beyond which a spelling is another name: about one error a part.
MOST_COST = 4.5
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20

#: Titles before and after names.
TITLES = r"(?i)\b(?:hon\s*[’'`]?\s*ble|hon(?=\.)|honourable|mr|mrs|ms|miss|smt|shri|sri|dr|prof|justice|chief justice|lord|acting)\b\.?|,?\s*\b(?:C\.?\s?J\.?\s?I?\.?|JJ\.?)\s*$"
#: Common short forms of English given names that no rule gives.
IRREGULAR = {
    "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "dick": "richard", "rick": "richard", "jack": "john",
    "hank": "henry", "harry": "henry", "hal": "henry", "ted": "theodore", "ned": "edward", "teddy": "edward", "jim": "james",
    "jem": "james", "chuck": "charles", "kit": "christopher", "sandy": "alexander", "sasha": "alexander", "tom": "thomas",
    "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "daisy": "margaret", "greta": "margaret", "molly": "mary",
    "polly": "mary", "sally": "sarah", "sadie": "sarah", "nell": "eleanor", "nancy": "anne", "nan": "anne", "patsy": "martha",
    "fanny": "frances", "frank": "francis", "kitty": "katherine", "dolly": "dorothy", "dot": "dorothy", "tess": "theresa", "gus": "augustus",
}
#: Endings of short forms.
ENDINGS = ("ie", "an", "en", "y", "i", "u", "e", "o", "a")


def plain(name: str) -> str:
    """A name in ASCII letters where accents allow, white space squeezed."""
    text = unicodedata.normalize("NFKD", name)
    return re.sub(r"\s+", " ", "".join(c for c in text if not unicodedata.combining(c))).strip()


def parts(name: str) -> tuple[list[str], bool, bool]:
    """(words in lower case, whether a comma followed the first part, whether a trailing J may be a title)."""
    text = re.sub(TITLES, " ", plain(name)).strip(" ,.")
    judge = bool(re.search(r"(?:,\s*|\s)J$", text))
    if judge:
        text = re.sub(r"(?:,\s*|\s)J$", "", text)
    text = text.strip(" ,.")
    comma = "," in text
    words: list[str] = []
    for piece in re.findall(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*", text.replace(".", " ")):
        words.append(piece.lower())
    return words, comma, judge


def fold(word: str) -> str:
    """Spellings of one sound brought together."""
    for a, b in (("ee", "i"), ("oo", "u"), ("aa", "a"), ("w", "v"), ("z", "j"), ("ph", "f"), ("th", "t"), ("dh", "d"), ("bh", "b"), ("gh", "g"), ("kh", "k"), ("x", "ks"), ("c", "k"), ("y", "i"), ("h", "")):
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def distance(a: str, b: str, most: int) -> int:
    """Edits between two words, a swap of neighbours counting one; most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


def word_cost(a: str, b: str) -> float | None:
    """Cost of reading a as a misspelt b; None if they are different words."""
    if a == b:
        return 0.0
    most = 1 if min(len(a), len(b)) < 5 else 2
    d = distance(a, b, most)
    if d <= most:
        return 0.5 + d
    if len(a) > 3 and fold(a) == fold(b):
        return 1.0
    return None


def short_form(a: str, b: str) -> float | None:
    """Cost of reading a as a short form of the given name b: by custom or because its stem begins b, or, dearer, because its
    stem of three letters or more stands in b; None if it is none."""
    if IRREGULAR.get(a) == b:
        return 0.4
    cost = None
    for ending in ("", *ENDINGS):
        if ending and not a.endswith(ending):
            continue
        stem = a.removesuffix(ending)
        if len(stem) > 2 and stem[-1] == stem[-2]:
            stem = stem[:-1]
        if 2 < len(stem) < len(b):
            if b.startswith(stem):
                return 0.4
            if len(fold(stem)) > 2 and fold(stem) in fold(b)[1:]:
                cost = 0.6
    return cost


def given_cost(a: str, b: str) -> float | None:
    """Cost of reading a as a form of the given name b."""
    if len(a) == 1:
        return 0.3 if a == b[0] else None
    if a == b:
        return 0.0
    if b.startswith(a) and len(a) < len(b):
        return 0.4
    cost = word_cost(a, b) if len(a) > 3 else None
    short = short_form(a, b)
    return cost if short is None else short if cost is None else min(short, cost)


def agreement(words: list[str], comma: bool, judge: bool, full: list[str]) -> float | None:
    """Cost of reading the words as the register's name; None if a part disagrees."""
    *given, surname = full
    best = None
    for at, word in enumerate(words):
        if len(word) < 3 or (comma and at) or (not comma and 0 < at < len(words) - 1):
            continue
        cost = word_cost(word, surname)
        if cost is None:
            continue
        rest = [w for i, w in enumerate(words) if i != at]
        if at == 0 and not comma and rest:
            cost += 0.2
        variants = [rest]
        if len(rest) == 1 and len(rest[0]) == 2:
            variants.append(list(rest[0]))
        if judge:
            variants += [[*rest, "j"]] if at == 0 else []
        for v, names in enumerate(variants):
            if len(names) > len(given):
                continue
            total = cost + (1.0 if not names else 0.0) + 0.1 * v
            for a, b in zip(names, given, strict=False):
                c = given_cost(a, b)
                if c is None:
                    break
                total += c
            else:
                total += 0.05 * (len(given) - len(names)) if names else 0.0
                best = total if best is None else min(best, total)
    return best if best is not None and best <= MOST_COST else None


def grams(name: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the words of a name, with marks at both ends of a word."""
    words = F.filter(F.split(F.regexp_replace(F.lower(F.regexp_replace(name, TITLES, " ")), r"[^\p{L}]+", " "), " "), lambda w: F.length(w) > 0)
    marked = F.transform(words, lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    return F.array_distinct(
        F.flatten(F.transform(marked, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(w) - (n - 1))), lambda i: F.substring(w, i, F.lit(n)))))
    )


def vectors(names: DataFrame, weights: DataFrame) -> DataFrame:
    """(name, gram, w): unit vectors of names; grams are weighted by their rarity in the register."""
    raw = names.select("name", F.explode(grams(F.col("name"))).alias("gram")).join(weights, "gram", "left")
    raw = raw.select("name", "gram", F.coalesce("idf", F.lit(1.0)).alias("w"))
    norm = raw.groupBy("name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "name").select("name", "gram", (F.col("w") / F.col("norm")).alias("w"))


def similar(left: DataFrame, right: DataFrame, top: int | None = TOP, least: float = LEAST_COSINE) -> DataFrame:
    """(name, other, cosine): for each name of left, its `top` nearest names of right with at least the given cosine (None: all)."""
    scores = (
        left.join(right.select(F.col("name").alias("other"), "gram", F.col("w").alias("v")), "gram")
        .groupBy("name", "other")
        .agg(F.sum(F.col("w") * F.col("v")).alias("cosine"))
        .where(F.col("cosine") >= least)
    )
    if top is None:
        return scores
    order = Window.partitionBy("name").orderBy(F.desc("cosine"), "other")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("rank")


def rare_part(vectors_: DataFrame, least: float) -> DataFrame:
    """The grams of each vector, the heaviest first, without which the rest is too short for a cosine of `least`: two unit
    vectors with that cosine share one of them."""
    before = Window.partitionBy("name").orderBy(F.desc("w"), "gram").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.lit(1.0) - F.coalesce(F.sum(F.col("w") * F.col("w")).over(before), F.lit(0.0))
    return vectors_.withColumn("rest", rest).where(F.col("rest") >= least * least - 1e-9).drop("rest")


def alike(names: DataFrame, near: int = NEAREST, least: float = ALIKE) -> DataFrame:
    """(name, other, cosine), name < other: pairs of spellings of which one is among the `near` nearest of the other.

    names(name, block, gram, w): only spellings of one block are compared. Pairs meet in a gram of their rare parts, so
    none with the least cosine is lost; their cosine is then taken over all grams.
    """
    rare = rare_part(names.select("name", "gram", "w").distinct(), least).select("name", "gram")
    met = names.join(rare, ["name", "gram"]).select("block", "gram", "name", "w")
    pairs = met.select("block", "gram", "name").join(met.select("block", "gram", F.col("name").alias("other")), ["block", "gram"]).where("name < other").select("name", "other").distinct()
    full = names.groupBy("name").agg(F.map_from_entries(F.collect_set(F.struct("gram", "w"))).alias("v"))  # a name's few grams
    dot = F.aggregate(F.map_entries("v"), F.lit(0.0), lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at("u", e["key"]), F.lit(0.0)))
    scored = pairs.join(full, "name").join(full.select(F.col("name").alias("other"), F.col("v").alias("u")), "other").select("name", "other", dot.alias("cosine")).where(F.col("cosine") >= least)
    both = scored.unionByName(scored.select(F.col("other").alias("name"), F.col("name").alias("other"), "cosine"))
    order = Window.partitionBy("name").orderBy(F.desc("cosine"), "other")
    kept = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= near)
    return kept.select(F.least("name", "other").alias("name"), F.greatest("name", "other").alias("other"), "cosine").distinct()


def average_linkage(names: DataFrame, pairs: DataFrame, least: float = LEAST_LINKAGE) -> DataFrame:
    """(name, group): groups of names by average linkage over the given similarities; absent pairs count as 0.

    Each round merges all pairs of groups that are each other's nearest with a mean of at least `least`; as such merges
    don't change which groups are nearest to others for the better, the result is that of merging one pair at a time. It ends
    when no pair is left. A group is named by its least name.
    """
    groups = written(names.select("name", F.col("name").alias("group"), F.lit(1).cast("long").alias("one")).distinct())
    edges = written(pairs.select(F.col("name").alias("a"), F.col("other").alias("b"), F.col("cosine").alias("sum")))
    sizes = groups.select(F.col("group").alias("g"), F.col("one").alias("size"))
    while True:
        sized = edges.join(sizes.select(F.col("g").alias("a"), F.col("size").alias("size_a")), "a").join(sizes.select(F.col("g").alias("b"), F.col("size").alias("size_b")), "b")
        close = sized.withColumn("mean", F.col("sum") / (F.col("size_a") * F.col("size_b"))).where(F.col("mean") >= least)
        ways = close.select("a", "b", "mean").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "mean"))
        best = ways.groupBy("a").agg(F.min_by("b", F.struct(-F.col("mean"), F.least("a", "b"), F.greatest("a", "b"))).alias("b"))
        back = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
        merged = written(best.join(back, ["a", "b"]).where("a < b").select(F.col("b").alias("from"), F.col("a").alias("into")))
        if merged.isEmpty():
            return groups.select("name", "group")
        renamed = lambda df, c: df.join(merged.withColumnRenamed("from", c), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")  # noqa: B023, E731
        groups = written(renamed(groups, "group"))
        moved = renamed(renamed(edges, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sum")
        edges = written(moved.groupBy("a", "b").agg(F.sum("sum").alias("sum")))
        sizes = groups.groupBy(F.col("group").alias("g")).agg(F.count(F.lit(1)).alias("size"))


def link_names(names: DataFrame, register: DataFrame) -> DataFrame:
    """(name, judge_id, cost, linkage) for the distinct spellings in names(name) that mean a person of register(judge_id, full_name).

    Null and blank names, names that fit no person, and names whose group has no clear nearest among the persons they fit
    equally well, or that are a mere surname of several, have no row. Equal names in the register fit equally well, so none of them is linked. Other columns are
    ignored; empty tables give no rows.
    """
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.where(F.trim("name") != "").select("name").distinct()
    people = one_per_key(register, "judge_id").where(F.col("full_name").isNotNull()).select("judge_id", F.col("full_name").alias("name"))
    count = people.count()
    weights = (
        people.select(F.explode(grams(F.col("name"))).alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("df"))
        .select("gram", (F.log(F.lit(count + 1.0) / F.col("df")) + 0.1).alias("idf"))
    )
    # few bytes but much work behind: spread by number, which adaptive execution leaves alone
    variants = checkpointed(vectors(names, weights).repartition(spread, "name"))
    known = checkpointed(vectors(people.select("name").distinct(), weights))

    def agree(batches: Iterator) -> Iterator:
        for pdf in batches:
            read = {n: parts(n) for n in pdf["name"].unique()}
            pdf["cost"] = [agreement(*read[n], [w.lower() for w in plain(o).split()]) for n, o in zip(pdf["name"], pdf["other"], strict=True)]
            pdf["alone"] = [len(read[n][0]) < 2 for n in pdf["name"]]
            yield pdf[pdf["cost"].notna()]

    def fitted(near: DataFrame) -> DataFrame:
        schema = T.StructType(near.schema.fields + [T.StructField("cost", T.DoubleType()), T.StructField("alone", T.BooleanType())])
        return near.mapInPandas(agree, schema)

    first = checkpointed(fitted(similar(variants, known)))
    left = variants.join(first.select("name").distinct(), "name", "left_anti")
    rest = fitted(similar(left, known, None, 0.0))  # beyond the top n: every person that shares an n-gram
    best = Window.partitionBy("name")
    fitting = first.unionByName(rest).join(people.select("judge_id", F.col("name").alias("other")), "other")
    fitting = checkpointed(
        fitting.withColumn("least", F.min("cost").over(best)).where(F.col("cost") <= F.col("least") + 0.01).drop("least").withColumn("n", F.count(F.lit(1)).over(best))
    )
    compared = fitting.select("name", F.col("judge_id").alias("block")).join(variants, "name")
    groups = average_linkage(fitting.select("name"), alike(compared))
    members = fitting.join(groups, "name")
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    linkage = members.groupBy("group", "judge_id").agg(F.sum("cosine").alias("sum")).join(sizes, "group").select("group", "judge_id", (F.col("sum") / F.col("size")).alias("linkage"))
    ranked = members.join(linkage, ["group", "judge_id"]).withColumn("next", F.lead("linkage").over(best.orderBy(F.desc("linkage"), "judge_id"))).withColumn("place", F.row_number().over(best.orderBy(F.desc("linkage"), "judge_id")))
    clear = F.col("next").isNull() | (~F.col("alone") & (F.col("linkage") - F.col("next") >= LEAD))
    return ranked.where((F.col("place") == 1) & clear).select("name", "judge_id", "cost", "linkage")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_table, record_id, pos, name): each name in the three tables once."""
    cases = one_per_key(table(spark, sf_dir, "cases").select("case_id", "bench"), "case_id")
    opinions = one_per_key(table(spark, sf_dir, "opinions").select("opinion_id", "author"), "opinion_id")
    sample = one_per_key(table(spark, sf_dir, "judgment_sample").select("file", "bench"), "file")
    out = cases.select(F.lit("cases").alias("record_table"), F.col("case_id").alias("record_id"), F.posexplode("bench").alias("pos", "name"))
    out = out.unionByName(
        opinions.select(F.lit("opinions").alias("record_table"), F.col("opinion_id").alias("record_id"), F.lit(0).alias("pos"), F.col("author").alias("name"))
    )
    out = out.unionByName(
        sample.select(F.lit("judgment_sample").alias("record_table"), F.col("file").alias("record_id"), F.posexplode(F.split("bench", "; ")).alias("pos", "name"))
    )
    return out.where(F.col("name").isNotNull())


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mentions(spark, sf_dir)
    links = link_names(found.select("name"), table(spark, sf_dir, "judges")).select("name", "judge_id")
    small = fits(links, BROADCAST_ROWS, BROADCAST_BYTES, F.octet_length("name") + 16)
    return found.join(F.broadcast(links) if small else links, "name")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    judges = table(spark, sf_dir, "judges").select("judge_id", "full_name").distinct()
    return (
        _linked(spark, sf_dir)
        .join(judges, "judge_id")
        .where(F.col("name") != F.coalesce("full_name", F.lit("")))
        .select("record_table", "record_id", F.col("pos").cast("int").alias("pos"), "judge_id")
    )


def p1_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of spellings and mentions of each judge."""
    return _linked(spark, sf_dir).groupBy("judge_id").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("name").alias("spellings"))
