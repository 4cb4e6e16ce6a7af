"""Short descriptions of cases: provisions and cases they are about, card texts, figures of a build, footnotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx


def top(df: DataFrame, group: str, by: list[Column], n: int, least: Column | None = None) -> DataFrame:
    """The first n rows of each group in an order that is total; rows that fail `least` don't count."""
    rows = df if least is None else df.where(least)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*by))).where(F.col("_r") <= n)


def _listed(df: DataFrame, group: str, value: Column, mark: str, name: str) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_r", value.alias("v")))), lambda x: x["v"])
    return df.groupBy(group).agg(F.array_join(ordered, mark).alias(name))


def summaries(statutes: DataFrame) -> DataFrame:
    """(case_id, summary): the four provisions cited most, twice at least; cases without such have no row.
    statutes(case_id, code, section, mentions, first)."""
    label = F.when(F.col("code") == "Constitution", F.concat(F.lit("Article "), "section", F.lit(" of the Constitution"))).otherwise(F.concat_ws(" ", "code", "section"))
    best = top(statutes, "case_id", [F.desc("mentions"), F.col("first"), F.col("code"), F.col("section")], 4, F.col("mentions") >= 2)
    return _listed(best, "case_id", label, ", ", "s").select("case_id", F.concat(F.lit("Mainly concerns "), "s").alias("summary"))


def cards(cases: DataFrame, statutes: DataFrame, cited: DataFrame) -> DataFrame:
    """(case_id, text): name, court, date, citations, bench, summary, the eight provisions cited most and the six cases named in most
    paragraphs. Details that a case lacks are left out. cited(case_id, first_key, name_hint, paragraphs)."""
    provisions = _listed(top(statutes, "case_id", [F.desc("mentions"), F.col("first"), F.col("code"), F.col("section")], 8), "case_id", F.concat_ws(" ", "code", "section"), ", ", "provisions")
    named = _listed(top(cited, "case_id", [F.desc(F.size("paragraphs")), F.col("first_key")], 6, F.col("name_hint").isNotNull()), "case_id", F.col("name_hint"), "; ", "named")
    df = cases.join(provisions, "case_id", "left").join(named, "case_id", "left")
    part = lambda head, value: F.when(F.length(value) > 0, F.concat(F.lit(head), value, F.lit(".")))
    first = F.concat("case_name", F.lit(". "), F.coalesce("court", F.lit("")), F.coalesce(F.concat(F.lit(", decided "), tx.date_words(F.col("case_date"))), F.lit("")), F.lit("."))
    text = F.concat_ws(
        " ", first, part("Citations: ", F.array_join("citations", "; ")), part("Bench: ", F.array_join("bench", ", ")), part("", F.regexp_replace("summary", r"\.+$", "")),
        part("Provisions discussed: ", F.col("provisions")), part("Cases referred to: ", F.col("named")),
    )
    return df.select("case_id", text.alias("text"))


def build_figures(passages: DataFrame) -> DataFrame:
    """Figures of each case's passages: number, sizes, blocks, not substantive, and counts by role as a map."""
    by = passages.groupBy("case_id", "role").agg(F.count(F.lit(1)).alias("n")).groupBy("case_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "n")))).alias("roles"))
    figures = passages.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.min("tokens").alias("tokens_min"), F.floor(F.percentile("tokens", 0.5)).cast("int").alias("tokens_median"), F.max("tokens").alias("tokens_max"),
        F.count_if(~F.col("substantive")).alias("not_substantive"),
    )
    return figures.join(by, "case_id")


def footnotes(lines: Column) -> Column:
    """Footnotes from the lines of a page's foot: a line that begins with the next number, alone or before text, opens a note; other
    lines go on with the one before. Lines before the first number are dropped."""
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).alias("last"))

    def step(a: Column, line: Column) -> Column:
        number = F.regexp_extract(F.trim(line), r"^(\d{1,3})(?:[.)]?\s+|$)", 1)
        n = F.when(number == "", F.lit(None)).otherwise(number.try_cast("int"))
        opens = n.isNotNull() & ((n == a["last"] + 1) | (F.size(a["done"]) == 0))
        rest = F.trim(F.regexp_replace(F.trim(line), r"^\d{1,3}(?:[.)]?\s+|$)", ""))
        go_on = F.concat(
            F.slice(a["done"], F.lit(1), F.greatest(F.size(a["done"]) - 1, F.lit(0))),
            F.array(F.trim(F.concat_ws(" ", F.try_element_at(a["done"], F.lit(-1)), F.trim(line)))),
        )
        return F.struct(
            F.when(opens, F.concat(a["done"], F.array(rest))).when(F.size(a["done"]) == 0, a["done"]).otherwise(go_on).alias("done"), F.when(opens, n).otherwise(a["last"]).alias("last")
        )

    return F.aggregate(F.filter(lines, lambda x: x.isNotNull() & (F.trim(x) != "")), state, step, lambda a: a["done"])


def case_figures(pages: DataFrame, paragraphs: DataFrame, passages: DataFrame) -> DataFrame:
    """The figures of a case's build in one row: pages, paragraphs, opinion segments, numbering, headings found, passages with their least, middle and
    greatest size, provisions and cases cited, blocks, passages that are not substantive, and passages by role.

    pages(case_id, page_id); paragraphs(case_id, para_id, segment, numbering, heading); passages(case_id, role, tokens, substantive, block_id,
    statutes, cited_cases). Each table is summed up by itself before the join; a case without rows in one has 0 there.
    """
    several = F.count_distinct("numbering") > 1
    a = pages.groupBy("case_id").agg(F.count_distinct("page_id").alias("pages"))
    b = paragraphs.groupBy("case_id").agg(
        F.count_distinct("para_id").alias("paragraphs"), F.count_distinct("segment").alias("opinion_segments"), F.when(several, "mixed").otherwise(F.max("numbering")).alias("para_numbering"), F.count_distinct(F.nullif("heading", F.lit(""))).alias("headings_found")
    )
    size = lambda name: F.coalesce(F.sum(F.size(name)), F.lit(0))
    c = build_figures(passages).join(passages.groupBy("case_id").agg(size("statutes").alias("statutes_cited"), size("cited_cases").alias("cases_cited"), F.count_distinct("block_id").alias("blocks")), "case_id")
    return a.join(b, "case_id", "full").join(c, "case_id", "full").fillna(0)
