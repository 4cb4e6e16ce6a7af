"""From printed lines to passages: the whole flow as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..operators import extract, layout, mapping, roles, segmentation, sequences
from ..sources.tables import checkpointed


def passages(pages: DataFrame, cases: DataFrame, table: DataFrame) -> DataFrame:
    """Passages with their payload from pages(doc_id, page, lines), the lines with line, text, gap and x0, cases(case_id, case_name, court, case_date, citations,
    bench, summary) and a mapping table. doc_id is the case_id. A paragraph above 384 tokens is cut into
    parts (chunk_part) at sentences. Paragraphs, their roles and the passages are checkpointed, as each is read several times.

    parse_quality is the state of the case's reading: reject without text or with a passage above the limit, review where numbers are
    lacking or missing, else ok. Keywords are the provisions, the cited cases' names and the heading, each once.
    """
    kept = layout.kept_lines(pages).withColumn("line_no", layout.line_number(F.col("page"), F.col("line")))
    paras = segmentation.paragraphs(kept.select("doc_id", "line_no", "page", "text", "x0", "gap")).withColumnRenamed("doc_id", "case_id")
    paras = checkpointed(paras.join(cases.select("case_id", "case_name"), "case_id", "left"))
    labelled = roles.label(paras, F.col("text").rlike(extract.SIGNS), F.col("text").rlike(r"\d{4}.*(?:SCC|AIR|SCR|INSC)"))
    packed = sequences.cut_long(sequences.pack(checkpointed(labelled)))
    name = ids.chunk_id(F.col("case_id"), F.col("segment"), F.col("first"), F.col("last"), F.col("chunk_part"))
    packed = checkpointed(packed.withColumn("chunk_id", name).withColumn("tokens", tx.tokens(F.col("text"))))
    refs = extract.statute_refs(packed.select("chunk_id", "text"), "text").select("chunk_id", F.col("ref.code").alias("code"), F.col("ref.section").alias("section"), F.col("ref.start").alias("start"))
    looked = mapping.lookup(refs, table)
    order = lambda v: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("start", v.alias("v")))), lambda x: x["v"]))
    cited = looked.withColumn("id", ids.statute_id(F.col("code"), F.col("section"))).groupBy("chunk_id").agg(order(F.col("id")).alias("statutes"), F.array_distinct(F.flatten(order(F.col("successors")))).alias("statutes_current"))
    cases_cited = extract.case_refs(packed.select("chunk_id", "text"), "text").select("chunk_id", "ref")
    at = lambda v: F.transform(F.array_sort(F.collect_list(F.struct(F.col("ref.start").alias("start"), v.alias("v")))), lambda x: x["v"])
    cases_cited = cases_cited.groupBy("chunk_id").agg(F.array_distinct(F.flatten(at(F.col("ref.keys")))).alias("cited_cases"), F.array_distinct(F.array_compact(at(F.col("ref.name_hint")))).alias("cited_names"))
    opinions = paras.groupBy("case_id", "segment").agg(F.max("numbering").alias("numbering"), F.max("author").alias("opinion_author"))
    several = opinions.groupBy("case_id").agg((F.count(F.lit(1)) > 1).alias("several"))
    gaps = sequences.number_gaps(paras.where("numbering = 'original'"), ["case_id", "segment"], "number").select("case_id").distinct().withColumn("gap", F.lit(True))
    over = packed.groupBy("case_id").agg(F.max(F.col("tokens") > 384).alias("over"), F.sum("tokens").alias("total"))
    linked = sequences.neighbours(packed, "case_id", ["segment", "chunk", "chunk_part"], "chunk_id")
    blocked = sequences.blocks(linked, "case_id", ["segment", "chunk", "chunk_part"], ["segment", "role", "heading"])
    df = blocked.join(cited, "chunk_id", "left").join(cases_cited, "chunk_id", "left").join(cases, "case_id", "left")
    df = df.join(opinions, ["case_id", "segment"], "left").join(several, "case_id", "left").join(gaps, "case_id", "left").join(over, "case_id", "left")
    some = (F.coalesce(F.size("statutes"), F.lit(0)) > 0) | (F.coalesce(F.size("cited_cases"), F.lit(0)) > 0)
    none = F.array().cast("array<string>")
    span = F.when(F.col("first") == F.col("last"), F.col("first")).otherwise(F.concat_ws("-", "first", "last"))
    quality = F.when(F.col("over") | (F.col("total") < 30), "reject").when(F.col("gap") | (F.col("numbering") != "original"), "review").otherwise("ok")
    plain = F.col("text").rlike(r"(?i)^\W*\d*\W*(?:leave granted|delay condoned|issue notice)\b[^.]{0,120}\.?\s*$")
    citation = F.get("citations", F.lit(0))
    return df.withColumns(
        {
            "substantive": (F.col("role") == "ruling") | some | (~plain & (F.col("tokens") >= 25)),
            "quoted_share": tx.quoted_share(F.col("text")),
            "parent_id": ids.parent_id(F.col("chunk_id")),
            "context": tx.context_line(F.col("case_name"), F.col("court"), tx.date_words(F.col("case_date")), citation, F.col("summary"), F.col("heading")),
            "para_numbering": F.col("numbering"),
            "cited_cases": F.coalesce("cited_cases", none),
            "keywords": F.array_distinct(F.array_compact(F.concat(F.coalesce("statutes", none), F.coalesce("cited_names", none), F.array(F.col("heading"))))),
            "cite_as": tx.cite_as(F.col("case_name"), citation, F.col("case_date"), F.col("numbering"), F.col("page_start"), span, F.col("opinion_author"), F.lit("unknown"), F.col("several")),
            "parse_quality": quality,
        }
    )
