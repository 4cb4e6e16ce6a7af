"""Pages read from words: lines, columns, footnotes; and the furniture of pages taken off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word this close to the one before is joined to it; lines this close are one; a step this wide is a gap.
JOIN, SAME_LINE, GAP = 1.0, 3.0, 1.45
SMALL, TINY = 0.78, 0.5
FURNITURE = r"(?i)^\s*(?:signature not verified|digitally signed by.*|date: \d{4}\.\d\d\.\d\d.*|reason:.*|\d{1,2}:\d\d:\d\d IST)\s*$"
PAGE_NUMBER = r"(?i)^\W*(?:page\s*)?\d{1,4}(?:\s*(?:of|/)\s*\d{1,4})?\W*$"


def body_size(words: DataFrame) -> DataFrame:
    """(doc_id, size): the font size of most characters, rounded to a tenth; of equals the larger."""
    by = words.where("size IS NOT NULL").groupBy("doc_id", F.round("size", 1).alias("size")).agg(F.sum(F.length("text")).alias("n"))
    return by.groupBy("doc_id").agg(F.max(F.struct("n", "size")).alias("m")).select("doc_id", "m.size")


def lines_of(words: DataFrame) -> DataFrame:
    """(doc_id, page, line, x0, top, text, gap) from words(doc_id, page, text, x0, x1, top, size).

    Words much smaller than the body are marks and are left out. Words whose tops differ little are one line, read from the
    left; those that touch are one word. gap tells that a line stands further below than the page's usual step.
    """
    w = words.join(body_size(words).withColumnRenamed("size", "body"), "doc_id", "left").where(F.coalesce(F.col("size") >= TINY * F.col("body"), F.lit(True)))
    page = Window.partitionBy("doc_id", "page").orderBy("top", "x0")
    new = F.coalesce((F.col("top") - F.lag("top").over(page)) > SAME_LINE, F.lit(True))
    w = w.withColumn("line", F.sum(new.cast("int")).over(page) - 1)
    word = F.struct("x0", "x1", "text")
    grouped = w.groupBy("doc_id", "page", "line").agg(F.min("x0").alias("x0"), F.min("top").alias("top"), F.array_sort(F.collect_list(word)).alias("ws"))
    text = F.aggregate(
        "ws",
        F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("end")),
        lambda a, x: F.struct(
            F.concat(a["t"], F.when(a["end"].isNull() | (x["x0"] - a["end"] < JOIN), "").otherwise(" "), x["text"]).alias("t"), x["x1"].cast("double").alias("end")
        ),
        lambda a: a["t"],
    )
    order = Window.partitionBy("doc_id", "page").orderBy("line")
    step = F.col("top") - F.lag("top").over(order)
    out = grouped.select("doc_id", "page", "line", "x0", "top", text.alias("text")).withColumn("step", step)
    pitch = out.where("step > 1").groupBy("doc_id", "page").agg(F.sort_array(F.collect_list("step")).alias("s"))
    usual = pitch.where(F.size("s") >= 4).select("doc_id", "page", F.element_at("s", (F.floor(F.size("s") / 2) + 1).cast("int")).alias("pitch"))
    return out.join(usual, ["doc_id", "page"], "left").withColumn("gap", F.coalesce(F.col("step") > GAP * F.col("pitch"), F.lit(False))).drop("step", "pitch")


def gutters(words: DataFrame) -> DataFrame:
    """(doc_id, page, gutter): where a page of two columns is divided: the place between 38 and 62 percent of its width, in steps
    of 3 points, that the fewest words cross, if almost none does and both sides hold a third of at least 120 words."""
    size = words.groupBy("doc_id", "page").agg(F.max("x1").alias("width"), F.count(F.lit(1)).alias("n")).where("n >= 120 AND width >= 300")
    at = F.explode(F.sequence(F.ceil(F.col("width") * 0.38).cast("int"), F.floor(F.col("width") * 0.62).cast("int"), F.lit(3)))
    tries = size.select("doc_id", "page", "n", at.alias("gutter"))
    w = words.select("doc_id", "page", "x0", "x1")
    score = (
        w.join(tries, ["doc_id", "page"])
        .groupBy("doc_id", "page", "gutter", "n")
        .agg(F.count_if((F.col("x0") < F.col("gutter")) & (F.col("x1") > F.col("gutter"))).alias("crossed"), F.count_if(F.col("x1") <= F.col("gutter")).alias("left"))
    )
    ok = score.where((F.col("crossed") <= F.col("n") * 0.02) & F.col("left").between(F.col("n") / 3, F.col("n") * 2 / 3))
    return ok.groupBy("doc_id", "page").agg(F.min(F.struct("crossed", "gutter")).alias("m")).select("doc_id", "page", F.col("m.gutter").alias("gutter"))


def kept_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page, kept) of pages(doc_id, page, lines) without stamps, page numbers at the edges and headers that recur on most pages; lines is an array
    of structs line, text, gap, x0 in order, and kept one of structs x (a line), drop and after (whether the line before was dropped).

    A header is an edge line whose shape, digits masked, stands on at least three and on 60 percent of a document's pages. A gap
    behind a dropped line, or before a page's first line, is none. Null and blank lines are left out. A page is read within its row; only
    the shapes of its four edge lines are counted across pages, and a document has at most six headers.
    """
    live = F.filter("lines", lambda x: F.coalesce(F.trim(x["text"]) != "", F.lit(False)))
    shape = lambda x: F.regexp_replace(F.trim(x["text"]), r"\d+", "#")
    rows = pages.where("doc_id IS NOT NULL").select("doc_id", "page", live.alias("live"))
    edges = F.filter(F.concat(F.slice("live", 1, 2), F.slice("live", F.greatest(F.lit(3), F.size("live") - 1), 2)), lambda x: ~x["text"].rlike(r"^\s*\d{1,3}\.\s"))
    shapes = rows.select("doc_id", "page", F.explode(F.array_distinct(F.transform(edges, shape))).alias("shape")).where("length(shape) > 3")
    seen = shapes.distinct().groupBy("doc_id", "shape").agg(F.count(F.lit(1)).alias("k"))
    count = pages.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"))
    often = seen.join(count, "doc_id").where((F.col("pages") >= 3) & (F.col("k") >= F.greatest(F.lit(3.0), F.col("pages") * 0.6)))
    headers = often.groupBy("doc_id").agg(F.collect_set("shape").alias("headers"))

    n = F.size("live")
    dropped = lambda x, i: x["text"].rlike(FURNITURE) | (((i < 2) | (i >= n - 2)) & (F.coalesce(F.array_contains("headers", shape(x)), F.lit(False)) | x["text"].rlike(PAGE_NUMBER)))
    marked = rows.join(headers, "doc_id", "left").select("doc_id", "page", "live", F.transform("live", dropped).alias("drop"))
    each = F.arrays_zip(F.col("live").alias("x"), F.col("drop").alias("drop"), F.concat(F.array(F.lit(True)), "drop").alias("after"))
    kept = F.filter(each, lambda e: ~e["drop"])  # the last place of `after` has no line
    return marked.select("doc_id", "page", kept.alias("kept"))


def kept_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, page, line, text, gap, x0): the lines of `kept_pages`."""
    flat = kept_pages(pages).select("doc_id", "page", F.posexplode("kept").alias("nth", "e"))
    gap = F.coalesce("e.x.gap", F.lit(False)) & ~F.col("e.after") & (F.col("nth") > 0)
    return flat.select("doc_id", "page", "e.x.line", "e.x.text", gap.alias("gap"), "e.x.x0")


def without_furniture(lines: DataFrame) -> DataFrame:
    """The same for single lines(doc_id, page, line, text, gap, ...): they are put together by page first. Other columns than x0 are dropped."""
    x0 = F.col("x0") if "x0" in lines.columns else F.lit(None).cast("double")
    each = F.struct("line", "text", "gap", x0.alias("x0"))
    pages = lines.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(each)).alias("lines"))  # a page's lines
    out = kept_lines(pages)
    return out if "x0" in lines.columns else out.drop("x0")


#: Points of a recognised page, by its resolution of 300 to the inch.
POINTS = 72 / 300


def lines_of_words(words: DataFrame) -> DataFrame:
    """(page_id, line_no, text, x0, top): the lines of recognised words(page_id, block, par, line, left, top, word), in order of their
    place; blank words are left out. A page's lines are ordered by top and left."""
    from pyspark.sql.window import Window

    rows = words.where(F.trim("word") != "").groupBy("page_id", "block", "par", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "word"))), lambda x: x["word"]), " ").alias("text"), (F.min("left") * POINTS).alias("x0"), (F.min("top") * POINTS).alias("top")
    )  # a line's words
    order = Window.partitionBy("page_id").orderBy("top", "x0", "block", "par", "line")
    return rows.select("page_id", (F.row_number().over(order) - 1).alias("line_no"), "text", "x0", "top")


def line_number(page: Column, line: Column) -> Column:
    """One number for the place of a line in a document, in order of pages and lines, whatever their numbers."""
    return F.shiftleft(page.cast("long"), 31) + line
