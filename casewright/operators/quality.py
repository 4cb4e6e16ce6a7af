"""Measures of a judgment's reading: words lost on the way, garbled words, sizes, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

WORDS = r"[A-Za-z0-9]+"
#: Fixed value: a hyphen at the end of a line, before the rest of its word.
BROKEN = r"(?<=\p{L})[-¬=‐\u00ad] (?=\p{Ll})"
#: Shapes of words that a reader damaged.
MALFORMED = r"^(?:.*[a-z][A-Z].*|.*[A-Za-z]\d+[A-Za-z].*|.*[^\x00-\x7F‘’“”–—].*|.*[^AEIOUYaeiouy\d]{6,}.*)$"


def word_counts(df: DataFrame, group: str, text: str) -> DataFrame:
    """(group, word, n): words in lower case; null texts have none."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORDS), F.lit(0))
    return df.select(group, F.explode(words).alias("word")).groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"))


def words_lost(first: DataFrame, second: DataFrame, group: str) -> DataFrame:
    """(group, total, lost): words counted in first and how many of them second lacks, by multiset difference."""
    both = first.withColumnRenamed("n", "a").join(second.withColumnRenamed("n", "b"), [group, "word"], "left")
    gone = F.greatest(F.col("a") - F.coalesce("b", F.lit(0)), F.lit(0))
    return both.groupBy(group).agg(F.sum("a").alias("total"), F.sum(gone).alias("lost"))


def outside_share(pages: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(case_id, outside): share of the words of a case's pages(doc_id, texts), the lines of a page in order, that are in no paragraph(case_id, number,
    text, heading), its number or heading, by multiset difference; words broken over lines are joined. A case without words on its
    pages has none."""
    pages = pages.select(F.col("doc_id").alias("case_id"), F.regexp_replace(tx.join_lines(F.col("texts")), BROKEN, "").alias("t"))
    said = paragraphs.select("case_id", F.concat_ws(" ", F.col("number").cast("string"), "text").alias("t"))
    heads = paragraphs.where("heading IS NOT NULL").select("case_id", F.col("heading").alias("t")).distinct()
    lost = words_lost(word_counts(pages, "case_id", "t"), word_counts(said.unionByName(heads), "case_id", "t"), "case_id")
    return lost.select("case_id", (F.col("lost") / F.col("total")).alias("outside"))


def garbled_share(pages: DataFrame, group: str, page: str, text: str, sample: int | None = None) -> DataFrame:
    """(group, words, garbled): share of malformed words of four letters or more on all pages.

    sample: as the studied system does, only about so many pages of each group, evenly spread; pages without a number are then left out.
    """
    if sample is not None:
        count = pages.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
        step = F.greatest(F.lit(1), F.floor(F.col("_n") / sample))
        pages = pages.join(count, group).where(F.pmod(F.col(page) - 1, step) == 0)
    words = pages.select(group, F.explode(F.split(F.col(text), r"\s+")).alias("word")).where(F.length("word") >= 4)
    return words.groupBy(group).agg(F.count(F.lit(1)).alias("words"), F.round(F.avg(F.col("word").rlike(MALFORMED).cast("int")), 6).alias("garbled"))


def sizes(df: DataFrame, group: str, size: str) -> DataFrame:
    """(group, n, least, middle, upper, most): middle is the whole part of the median, upper the upper middle element."""
    from pyspark.sql.window import Window

    each = df.where(F.col(size).isNotNull()).groupBy(group, F.col(size).alias("v")).agg(F.count(F.lit(1)).alias("k"))  # a row for each distinct size
    up_to = F.sum("k").over(Window.partitionBy(group).orderBy("v"))
    ranked = each.withColumn("to", up_to).withColumn("n", F.sum("k").over(Window.partitionBy(group)))
    at = lambda rank: F.min(F.when(F.col("to") >= rank, F.col("v")))
    found = ranked.groupBy(group).agg(F.max("n").alias("n"), F.min("v").alias("least"), at(F.floor((F.col("n") + 1) / 2)).alias("lower"), at(F.floor(F.col("n") / 2) + 1).alias("upper"), F.max("v").alias("most"))
    return found.select(group, "n", "least", F.floor((F.col("lower") + F.col("upper")) / 2).cast("int").alias("middle"), "upper", "most")


def verdict(figures: DataFrame) -> DataFrame:
    """figures with status (ok, review, reject) and reasons(level, reason): the worst level counts, notes never do.

    figures: unread, words, chunks, lost, outside, over, gap_opinions, unnumbered, opinions, pages, paragraphs, unknown_kinds, nameless,
    rough, scanned, garbled, two_columns, layout, source, missing, conflicts, court. Null figures raise nothing.
    """
    c = F.col
    read = c("source").isin("auto", "dataset")
    lacks = lambda x: F.coalesce(F.array_contains("missing", x), F.lit(False))
    empty = (c("chunks") == 0) | (c("words") < 30)
    rules: list[tuple[str, Column, str]] = [
        ("reject", c("unread") > 0, "pages that could not be read"),
        ("reject", empty, "hardly any text"),
        ("reject", (c("source") == "auto") & lacks("parties") & lacks("bench") & (c("nameless") == c("opinions")), "no parties, bench or author"),
        ("reject", c("lost") > 0, "words did not reach a chunk"),
        ("reject", c("outside") > 0.25, "much text in no paragraph"),
        ("review", (c("outside") > 0.06) & (c("outside") <= 0.25), "some text in no paragraph"),
        ("reject", c("over") > 0, "chunks over the limit"),
        ("review", c("gap_opinions") > 0, "paragraph numbers not continuous"),
        ("review", c("unnumbered") > 0, "no paragraph numbers"),
        ("review", (c("pages") >= 12) & (c("paragraphs") < c("pages") / 8), "few paragraphs"),
        ("review", (c("opinions") > 1) & (c("unknown_kinds") > 0), "kinds of opinions unknown"),
        ("review", (c("nameless") > 0) & (c("nameless") < c("opinions")), "opinions without author"),
        ("review", c("rough") > 0, "approximate openings"),
        ("review", c("scanned") > 0, "pages read by recognition"),
        ("reject", c("garbled") > 0.03, "many malformed words"),
        ("review", (c("garbled") > 0.008) & (c("garbled") <= 0.03), "some malformed words"),
        ("review", c("two_columns") > 0, "pages in two columns"),
        ("review", c("layout") == "law_report", "law report"),
        ("review", read & lacks("parties"), "parties not found"),
        ("review", read & lacks("date"), "date not found"),
        ("review", read & lacks("bench"), "bench not found"),
        ("note", read & lacks("citation"), "no citation"),
        ("review", (c("source") == "dataset") & (F.size("conflicts") > 0), "record disagrees"),
        ("review", c("court") != "Supreme Court", "another court"),
    ]
    stop = F.coalesce(empty, F.lit(False))
    found = [F.when(F.coalesce(test, F.lit(False)) & (~stop if i > 1 else F.lit(True)), F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"))) for i, (level, test, reason) in enumerate(rules)]
    out = figures.withColumn("reasons", F.array_compact(F.array(*found)))
    levels = F.transform("reasons", lambda r: r["level"])
    return out.withColumn("status", F.when(F.array_contains(levels, "reject"), "reject").when(F.array_contains(levels, "review"), "review").otherwise("ok"))


def multiset_union(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """Counts of two multisets (keys, n) added up, with partial sums before the shuffle."""
    return first.select(*keys, "n").unionByName(second.select(*keys, "n")).groupBy(*keys).agg(F.sum("n").alias("n"))


def modal(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """(group, value, n): the most frequent value of each group, of equal ones the one that comes first; nulls don't count."""
    each = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
    return each.groupBy(group).agg(F.max_by(value, F.struct("n", -F.col("_first"))).alias(value), F.max("n").alias("n"))


def admitted(found: DataFrame, force: bool = False, only_ok: bool = False) -> DataFrame:
    """found(case_id, file, status, doc_sha256) with `refused`, the reason for which a document isn't ingested; null admits it.

    Of several files of one case the first is read; a rejected one needs force, one for review is refused if only sound ones
    are asked for; a document that stands under an earlier case is a duplicate. Each gate sees what passed the one before.
    """
    from pyspark.sql.window import Window

    rank = lambda key: F.row_number().over(Window.partitionBy(key).orderBy("case_id", "file"))
    out = found.withColumn("refused", F.when(rank("case_id") > 1, "another file of the case"))
    status = F.when((F.col("status") == "reject") & F.lit(not force), "rejected").when((F.col("status") == "review") & F.lit(only_ok), "for review")
    out = out.withColumn("refused", F.coalesce("refused", status))
    open_ = F.when(F.col("refused").isNull() & F.col("doc_sha256").isNotNull(), F.struct("case_id", "file"))
    first = F.min(open_).over(Window.partitionBy("doc_sha256"))
    double = F.when(open_.isNotNull() & (open_ > first) & F.lit(not force), "the document of another case")
    return out.withColumn("refused", F.coalesce("refused", double))
