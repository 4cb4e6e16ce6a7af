"""Balanced samples of judgments and the matching of question sets to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates

ERAS = ("1950-1989", "1990-2009", "2010-2025")


def hash_order(key: Column, seed: int) -> Column:
    """A seeded order that every engine reproduces."""
    return F.md5(F.concat(key, F.lit(f"|{seed}")))


def balanced(df: DataFrame, size: int = 100, seed: int = 20261007, criminal_share: float = 0.4) -> DataFrame:
    """A sample of judgments(path, year, bench, decision_date, bench_size, case_number, pages): an equal quota for each era; within
    it large benches first, then criminal matters by length, then civil ones by length, and the rest in seeded order.

    Rows without bench or date are left out, as are years outside the eras. Tiers are counted by ranks within (era, tier),
    so the deepest window holds one tier of one era; only rows within the quotas survive it. Where a tier falls short, the rest fills up.
    """
    era, length = dates.era(F.col("year")), dates.length_class(F.col("pages"))
    pool = df.where((F.coalesce("bench", F.lit("")) != "") & (F.coalesce("decision_date", F.lit("")) != "")).withColumn("era", era).where("era IS NOT NULL")
    base, extra = divmod(size, len(ERAS))
    want = F.lit(base) + F.when(F.col("era").isin(*ERAS[:extra]), 1).otherwise(0)
    criminal = dates.is_criminal(F.col("case_number"))
    large = F.coalesce(F.col("bench_size") >= 5, F.lit(False))
    pool = pool.withColumn("h", hash_order(F.col("path"), seed)).withColumn("want", want)
    first = pool.withColumn("r", F.row_number().over(Window.partitionBy("era", large).orderBy("h", "path"))).withColumn("top", large & (F.col("r") <= F.greatest(F.lit(3), F.floor(F.col("want") / 10))))
    share = F.when(length == "medium", 0.5).otherwise(0.25) * F.when(criminal, criminal_share).otherwise(1 - criminal_share)
    tier = F.concat_ws("-", F.when(criminal, "1").otherwise("2"), length)
    second = first.withColumn("tier", F.when(F.col("top"), "0").otherwise(tier)).withColumn("k", F.row_number().over(Window.partitionBy("era", "tier").orderBy("h", "path")))
    within = F.col("top") | (F.col("k") <= F.bround(F.col("want") * share))
    level = F.when(F.col("top"), 0).when(within & criminal, 1).when(within, 2).otherwise(3)
    ranked = second.withColumn("level", level).withColumn("n", F.row_number().over(Window.partitionBy("era").orderBy("level", "h", "path")))
    return ranked.where("n <= want").select(*df.columns, "era")


def described(df: DataFrame) -> DataFrame:
    """(measure, value, n): counts by era, length, matter and bench size, from one pass with grouping sets."""
    bench = F.coalesce(F.concat(F.col("bench_size").cast("string"), F.lit(" judges")), F.lit("bench unknown"))
    cols = df.select(
        dates.era(F.col("year")).alias("era"), dates.length_class(F.col("pages")).alias("length"),
        F.when(dates.is_criminal(F.col("case_number")), "criminal").otherwise("civil / other").alias("matter"), bench.alias("bench"),
    )
    names = ["era", "length", "matter", "bench"]
    sets = cols.groupingSets([[c] for c in names], *names).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    at = F.element_at(F.array(*[F.lit(n) for n in names]), F.when(F.col("g") == 7, 1).when(F.col("g") == 11, 2).when(F.col("g") == 13, 3).otherwise(4))
    return sets.select(at.alias("measure"), F.coalesce(*names).alias("value"), "n").where("value IS NOT NULL")


#: Words of case names that tell nothing, and words that stand on one side of thousands of cases.
COMMON = (
    "state union india others another anr ors versus through limited private company singh kumar govt government secretary ltd "
    "andhra arunachal assam bihar chhattisgarh goa gujarat haryana himachal jharkhand karnataka kerala madhya maharashtra manipur "
    "meghalaya mizoram nagaland odisha orissa punjab rajasthan sikkim tamil nadu telangana tripura uttar uttarakhand pradesh west "
    "bengal delhi jammu kashmir ladakh chandigarh puducherry pondicherry territory national capital commissioner principal income "
    "central excise customs service director general collector deputy assistant officer registrar chief department ministry inspector "
    "police station investigation bureau authority board corporation municipal appellant respondent petitioner anor etc"
).split()


def name_words(name: Column) -> Column:
    """Distinctive words of a case's name or a party: runs of four letters or more, without the common ones."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit("[a-z]{4,}"), F.lit(0))), F.array(*[F.lit(w) for w in COMMON]))


def match_questions(questions: DataFrame, judgments: DataFrame) -> DataFrame:
    """(question_id, path): the judgment of a question's case.

    It was decided on the same day, its title shares a word with each side of the case's name that has a distinctive one (in
    whatever order the sides stand), and most words of all such, without a tie. questions(question_id, case_name, date), the
    date in any of seven written forms; judgments(path, title, day). Questions and judgments meet in a day and a word, so a
    busy day is spread over its words. Null names, titles and days match nothing.
    """
    j = judgments.select("path", F.col("day"), name_words(F.col("title")).alias("words")).where("day IS NOT NULL AND size(words) > 0")
    sides = F.filter(F.transform(F.split("case_name", r"(?i)\s+(?:vs?\.?|versus)\s+"), name_words), lambda w: F.size(w) > 0)
    q = questions.select("question_id", dates.question_date(F.col("date")).alias("day"), sides.alias("sides")).where("day IS NOT NULL AND size(sides) > 0")
    met = (
        q.select("question_id", "day", F.explode(F.array_distinct(F.flatten("sides"))).alias("word"))
        .join(j.select("path", "day", F.explode("words").alias("word")), ["day", "word"])
        .groupBy("question_id", "path")
        .agg(F.count(F.lit(1)).alias("score"))
    )
    agreed = met.join(q.select("question_id", "sides"), "question_id").join(j.select("path", "words"), "path").where(F.forall("sides", lambda w: F.arrays_overlap(w, F.col("words"))))
    best = agreed.groupBy("question_id").agg(F.max("score").alias("most"))
    top = agreed.join(best, "question_id").where("score = most").groupBy("question_id").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n"))
    return top.where("n = 1").select("question_id", "path")


def limited(df: DataFrame, key: str, size: int, seed: int = 20261007) -> DataFrame:
    """At most size rows of df in a seeded order; null keys are left out."""
    return df.where(F.col(key).isNotNull()).orderBy(hash_order(F.col(key).cast("string"), seed), key).limit(size)


def question_set(questions: DataFrame, matched: DataFrame, cases: DataFrame) -> DataFrame:
    """(query, case_id, paragraphs): the rows of a question file: questions(question_id, query) whose judgment is known by
    matched(question_id, path) and cases(path, case_id). No paragraph is known, so any passage of the case is an answer."""
    found = questions.join(matched, "question_id").join(cases.select("path", "case_id").distinct(), "path")
    return found.select("query", "case_id", F.array().cast("array<int>").alias("paragraphs"))
