"""Queries of the operators on whole documents: segmentation, furniture, roles, packing, payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..operators import extract, layout, roles, segmentation, sequences
from ..sources.tables import one_per_key, table
from .relational_q import CHUNKS, CITED, chunks, paragraphs

QUERIES: dict = {}
ORACLES: dict = {}
c = F.col


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, lines) of all pages, a line with its number, text, gap and x0."""
    p = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", "page_number", "lines", "x0", "gap"), "page_id")
    line = lambda text, i: F.struct(i.alias("line"), text.alias("text"), F.get("gap", i).alias("gap"), F.get("x0", i).alias("x0"))
    return p.select(c("case_id").alias("doc_id"), c("page_number").alias("page"), F.transform("lines", line).alias("lines"))


@query("seg_furniture")
def seg_furniture(spark, sf_dir):
    """Lines left on each page once its furniture is off."""
    kept = layout.kept_lines(page_rows(spark, sf_dir))
    return kept.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("gap").alias("gaps"))


@query("seg_paragraphs")
def seg_paragraphs(spark, sf_dir):
    """Paragraphs read from the printed lines of each case."""
    kept = layout.kept_lines(page_rows(spark, sf_dir))
    lines = kept.withColumn("line_no", layout.line_number(c("page"), c("line")))
    return segmentation.paragraphs(lines.select("doc_id", "line_no", "page", "text", "x0", "gap")).select("doc_id", "para_seq", "segment", "number", "page", "heading", "numbering", F.length("text").alias("chars"))


@query("seg_headers")
def seg_headers(spark, sf_dir):
    """What stands before the first opinion of each case."""
    kept = layout.kept_lines(page_rows(spark, sf_dir))
    lines = kept.withColumn("line_no", layout.line_number(c("page"), c("line")))
    return segmentation.headers(lines.select("doc_id", "line_no", "page", "text", "x0", "gap"))


@query("seg_by_construction", """
    SELECT case_id AS doc_id, n AS number, 'Para ' || n || ' of the case stands here.' AS text FROM (SELECT DISTINCT case_id FROM cases WHERE case_id IS NOT NULL), (SELECT unnest(range(1, 7)) AS n)""")
def seg_by_construction(spark, sf_dir):
    """Six numbered paragraphs, each wrapped over two lines, are found again."""
    cases = table(spark, sf_dir, "cases").where("case_id IS NOT NULL").select("case_id").distinct()
    one = cases.select(c("case_id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.lit(13))).alias("line_no"))
    n = F.floor(c("line_no") / 2)
    text = F.when(c("line_no") == 0, "A v. B").when(c("line_no") == 1, "JUDGMENT").when(c("line_no") % 2 == 0, F.concat(n.cast("string"), F.lit(". Para "), n.cast("string"), F.lit(" of the"))).otherwise("case stands here.")
    lines = one.select("doc_id", "line_no", F.lit(1).alias("page"), text.alias("text"), F.lit(72.0).alias("x0"), F.lit(False).alias("gap"))
    return segmentation.paragraphs(lines).select("doc_id", "number", "text")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = paragraphs(spark, sf_dir)
    cases = one_per_key(table(spark, sf_dir, "cases").select("case_id", "case_name"), "case_id")
    df = p.join(cases, "case_id", "left").drop("loaded_at")
    law = c("text").rlike(r"(?:Section|Article)s?\s+\d|§\s*\d")
    case = c("text").rlike(r"\b(?:RAD|R\.A\.D\.|AFR|SCC|AIR|SCR)\b")
    return roles.label(df, F.coalesce(law, F.lit(False)), F.coalesce(case, F.lit(False)))


@query("role_labels")
def role_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("para_id", "role")


@query("role_construction", """
    SELECT para_id, CASE para_seq % 4 WHEN 0 THEN 'argument_petitioner' WHEN 1 THEN 'argument_respondent' WHEN 2 THEN 'argument_respondent' ELSE 'issue' END AS role
    FROM (SELECT case_id || '#' || x AS para_id, x AS para_seq FROM (SELECT DISTINCT case_id FROM cases), (SELECT unnest(range(0, 8)) AS x))""")
def role_construction(spark, sf_dir):
    """Counsel, the other side, a continuation and an issue are told apart, whoever spoke before."""
    cases = table(spark, sf_dir, "cases").select("case_id").distinct()
    p = cases.select("case_id", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("para_seq"))
    said = ["Learned counsel for the appellant submitted that the order is bad.", "Per contra, the order was said to be good.", "It was further contended that nothing more is due.", "The question for consideration is a short one."]
    text = F.element_at(F.array(*[F.lit(x) for x in said]), (c("para_seq") % 4 + 1).cast("int"))
    df = p.select("case_id", F.lit(0).alias("segment"), "para_seq", text.alias("text"), F.lit(None).cast("string").alias("heading"), F.lit("A v. B").alias("case_name"))
    return roles.label(df, F.lit(False), F.lit(False)).select(F.concat_ws("#", "case_id", c("para_seq").cast("string")).alias("para_id"), "role")


@query("chk_pack")
def chk_pack(spark, sf_dir):
    """Chunks packed from all labelled paragraphs, long ones cut."""
    packed = sequences.cut_long(sequences.pack(labelled(spark, sf_dir)))
    name = ids.chunk_id(c("case_id"), c("segment"), c("first"), c("last"), c("chunk_part"))
    return packed.select(name.alias("chunk_id"), "case_id", "segment", "para_start", "para_end", "chunk_part", tx.tokens(c("text")).alias("tokens"), "role", "heading", "long")


@query("chk_pack_tokens", """
    SELECT case_id, segment, sum(len(coalesce(text, '')))::BIGINT AS chars, count(*) AS paragraphs FROM (SELECT DISTINCT ON (para_id) case_id, coalesce(segment, 0) AS segment, text FROM paragraphs WHERE para_id IS NOT NULL) GROUP BY 1, 2""")
def chk_pack_tokens(spark, sf_dir):
    """No character is lost on the way into chunks: characters and paragraphs of each opinion, counted from the chunks."""
    p = paragraphs(spark, sf_dir).withColumn("role", F.lit("facts"))
    packed = sequences.pack(p)
    spaces = F.size("labels") - 1
    return packed.groupBy("case_id", "segment").agg(F.sum(F.length("text") - spaces).cast("long").alias("chars"), F.sum(F.size("labels")).cast("long").alias("paragraphs"))


@query("pay_passages", f"""
    WITH c AS {CHUNKS}, m AS (SELECT DISTINCT ON (case_id) * FROM cases)
    SELECT c.chunk_id, c.case_id, m.case_name, regexp_replace(c.chunk_id, '_\\d+$', '') AS parent_id, m.court, strftime(m.case_date, '%Y-%m-%d') AS date, m.citations[1] AS citation,
           CASE WHEN c.para_start = c.para_end THEN c.para_start::VARCHAR ELSE c.para_start || '-' || c.para_end END AS span, c.chunk_part
    FROM c LEFT JOIN m ON c.case_id = m.case_id""")
def pay_passages(spark, sf_dir):
    """Passages with the details of their case."""
    meta = one_per_key(table(spark, sf_dir, "cases"), "case_id").select("case_id", "case_name", "court", F.date_format("case_date", "yyyy-MM-dd").alias("date"), F.get("citations", F.lit(0)).alias("citation"))
    span = F.when(c("para_start") == c("para_end"), c("para_start").cast("string")).otherwise(F.concat_ws("-", c("para_start").cast("string"), c("para_end").cast("string")))
    rows = chunks(spark, sf_dir).select("chunk_id", "case_id", ids.parent_id(c("chunk_id")).alias("parent_id"), span.alias("span"), "chunk_part")
    return rows.join(meta, "case_id", "left")


CITED_IN_PARAS = rf"""
    SELECT case_id, number, regexp_replace(regexp_extract(m, 'of\s+the\s+(.*)$', 1, 's'), '\s+', ' ', 'g') AS code, regexp_replace(regexp_extract(m, '\d{{1,3}}[A-Z]{{0,2}}(?:\s?\([0-9A-Za-z]{{1,3}}\))*'), '\s', '', 'g') AS section
    FROM (SELECT case_id, number, unnest(regexp_extract_all(text, '{CITED}')) AS m FROM (SELECT DISTINCT ON (para_id) * FROM paragraphs WHERE para_id IS NOT NULL))"""


@query("ext_paragraph_refs", f"SELECT case_id, code, section, count(*) AS mentions, coalesce(array_to_string(list_sort(list(DISTINCT number) FILTER (WHERE number IS NOT NULL)), ','), '') AS paragraphs FROM ({CITED_IN_PARAS}) GROUP BY 1, 2, 3")
def ext_paragraph_refs(spark, sf_dir):
    """Provisions of the codes that the paragraphs cite, by case."""
    p = paragraphs(spark, sf_dir).select("case_id", "number", "text")
    found = extract.statutes_of_cases(extract.statute_refs(p, "text"))
    return found.select("case_id", "code", "section", "mentions", F.array_join(F.transform("paragraphs", lambda x: x.cast("string")), ",").alias("paragraphs"))


@query("ext_acts", r"""
    SELECT para_id, len(regexp_extract_all(text, 'Section \d{1,3}A?(?:\([0-9a-z]\))* of the [A-Z][a-z]+ (?:[A-Z][a-z]+ )*Act, \d{4}')) AS n FROM (SELECT DISTINCT ON (para_id) para_id, text FROM paragraphs)
    WHERE regexp_matches(text, 'Section \d{1,3}A?(?:\([0-9a-z]\))* of the [A-Z][a-z]+ (?:[A-Z][a-z]+ )*Act, \d{4}')""")
def ext_acts(spark, sf_dir):
    """Sections of named Acts in the real paragraphs, where written in full."""
    found = extract.statute_refs(paragraphs(spark, sf_dir).select("para_id", "text"), "text")
    full = found.where(c("ref.raw").rlike(r"^Section \d{1,3}A?(?:\([0-9a-z]\))* of the [A-Z][a-z]+ (?:[A-Z][a-z]+ )*Act, \d{4}$"))
    return full.groupBy("para_id").agg(F.count(F.lit(1)).alias("n"))




@query("rec_titles", """
    SELECT DISTINCT ON (file) file, string_split(title, ' versus ')[1] AS raw, CASE WHEN regexp_matches(decision_date, '^\\d{4}') THEN decision_date ELSE regexp_replace(decision_date, '^(\\d{2})-(\\d{2})-(\\d{4})$', '\\3-\\2-\\1') END AS date
    FROM judgment_sample WHERE file IS NOT NULL AND title IS NOT NULL AND decision_date IS NOT NULL""")
def rec_titles(spark, sf_dir):
    """Parties and dates printed in title blocks are read back from them."""
    from ..functions import dates
    from ..operators import records

    s = one_per_key(table(spark, sf_dir, "judgment_sample"), "file").where("title IS NOT NULL AND decision_date IS NOT NULL")
    parties = F.split("title", " versus ")
    day = F.date_format(F.try_to_date(dates.iso_date(c("decision_date"))), "MMMM d, yyyy")
    head = F.array(parties[0], F.lit("v."), F.get(parties, F.lit(1)), day, F.lit("[RAO, SEN, JJ.]"))
    block = s.select("file", parties[0].alias("raw"), records.title_block(head).alias("t"))
    return block.where(F.size("t.bench") == 2).select("file", "raw", c("t.date").cast("string").alias("date"))


@query("rec_reports")
def rec_reports(spark, sf_dir):
    """Title blocks of the reported cases."""
    from ..operators import records

    r = one_per_key(table(spark, sf_dir, "law_reports").select("case_id", "header"), "case_id")
    t = r.select("case_id", records.title_block(F.slice(F.split("header", "\n"), 1, 6)).alias("t"))
    return t.select("case_id", "t.petitioner", "t.respondent", c("t.date").cast("string").alias("date"), F.array_join("t.bench", "; ").alias("bench"))


@query("rec_merged")
def rec_merged(spark, sf_dir):
    """Records of the cases merged with the index's by file."""
    from ..functions import dates
    from ..operators import records

    a = one_per_key(table(spark, sf_dir, "cases"), "file").select("file", F.lower("case_name").alias("parties"), c("case_date").alias("date"), "bench", "citations", F.lit(None).cast("string").alias("author"))
    s = one_per_key(table(spark, sf_dir, "judgment_sample"), "file")
    b = s.select("file", F.lower(F.regexp_replace("title", " versus ", " v. ")).alias("parties"), F.try_to_date(dates.iso_date(c("decision_date"))).alias("date"), F.split("bench", "; ").alias("bench"), F.array_compact(F.array("citation", "neutral_citation")).alias("citations"), "author")
    m = records.merged(a, b, "file")
    return m.select("file", c("date").cast("string").alias("date"), F.array_join("citations", "|").alias("citations"), c("field_sources")["date"].alias("date_source"), F.size("conflicts").alias("n_conflicts"))


@query("rec_kinds", """
    SELECT DISTINCT opinion_id, CASE WHEN opinion_type IN ('partly_dissenting', 'dissenting', 'concurring', 'majority') THEN opinion_type ELSE 'unknown' END AS kind FROM opinions WHERE opinion_type IS NOT NULL""")
def rec_kinds(spark, sf_dir):
    from ..operators import records

    o = one_per_key(table(spark, sf_dir, "opinions").select("opinion_id", "opinion_type"), "opinion_id").where("opinion_type IS NOT NULL")
    said = F.when(c("opinion_type") == "partly_dissenting", "A, J. (dissenting in part)").otherwise(F.concat(F.lit("A, J. ("), "opinion_type", F.lit(")")))
    return o.select("opinion_id", records.opinion_kind(said).alias("kind"))


@query("qua_verdicts")
def qua_verdicts(spark, sf_dir):
    """Verdict on each case from its measures."""
    from ..operators import quality

    cases = one_per_key(table(spark, sf_dir, "cases"), "case_id").select("case_id", "source", "missing", "conflicts", "court", "layout")
    ch, pa = chunks(spark, sf_dir), paragraphs(spark, sf_dir)
    words = quality.words_lost(quality.word_counts(pa, "case_id", "text"), quality.word_counts(ch, "case_id", "text"), "case_id").select("case_id", c("total").alias("words"), "lost")
    pages = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", "page_number", "ocr", "needs_ocr", "n_columns", F.array_join("lines", " ").alias("t")), "page_id")
    read = pages.groupBy("case_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if("needs_ocr").alias("unread"), F.count_if("ocr").alias("scanned"), F.count_if(c("n_columns") == 2).alias("two_columns"))
    bad = quality.garbled_share(pages, "case_id", "page_number", "t").select("case_id", "garbled")
    ops = one_per_key(table(spark, sf_dir, "opinions"), "opinion_id").groupBy("case_id").agg(F.count(F.lit(1)).alias("opinions"), F.count_if(c("numbering") == "synthetic").alias("unnumbered"), F.count_if(c("opinion_type") == "unknown").alias("unknown_kinds"), F.count_if(c("author_line").isNull()).alias("nameless"))
    sizes = ch.groupBy("case_id").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(tx.tokens(c("text")) > 384).alias("over"))
    counted = pa.groupBy("case_id").agg(F.count(F.lit(1)).alias("paragraphs"))
    gaps = sequences.number_gaps(pa, ["case_id", "segment"], "number").groupBy("case_id").agg(F.count(F.lit(1)).alias("gap_opinions"))
    df = cases
    for part in (words, read, bad, ops, sizes, counted, gaps):
        df = df.join(part, "case_id", "left")
    outside = quality.outside_share(layout.kept_pages(page_rows(spark, sf_dir)).select("doc_id", F.transform("kept", lambda e: e["x"]["text"]).alias("texts")), pa)
    df = df.join(outside, "case_id", "left")
    # no reader of these tables places openings approximately, so that rule isn't built
    df = df.withColumn("rough", F.lit(None).cast("int")).fillna(0, ["gap_opinions", "chunks", "words"])
    return quality.verdict(df).select("case_id", "status", F.size("reasons").alias("n_reasons"))


@query("str_windows", """
    SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) // 1000000 AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def str_windows(spark, sf_dir):
    """Windowed counts of the event table as a batch; the same plan runs as a stream."""
    from ..streaming import ingest

    out = ingest.counts_by_window(table(spark, sf_dir, "events"))
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("pay_pipeline")
def pay_pipeline(spark, sf_dir):
    """Passages of all cases, from the printed lines to the payload."""
    from . import pipeline
    from .relational_q import examples

    cases = one_per_key(table(spark, sf_dir, "cases"), "case_id").select("case_id", "case_name", "court", "case_date", "citations", "bench", "summary")
    rows = pipeline.passages(page_rows(spark, sf_dir), cases, examples(spark))
    return rows.select(
        "chunk_id", "case_id", "chunk_part", "long", "role", "tokens", "substantive", "block_id", "block_index", "prev_chunk_id", "next_chunk_id", F.length("context").alias("context_chars"),
        "para_numbering", "opinion_author", F.array_join("cited_cases", "|").alias("cited_cases"), F.array_join("keywords", "|").alias("keywords"), "cite_as", "parse_quality",
    )


@query("pay_cards", f"""
    WITH s AS (SELECT case_id, rhetorical_role AS section, count(*) AS mentions, min(para_start) AS first FROM {CHUNKS} WHERE case_id IS NOT NULL AND rhetorical_role IS NOT NULL GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY mentions DESC, first, section) AS k FROM s),
         t AS (SELECT case_id, string_agg('role ' || section, ', ' ORDER BY k) AS provisions FROM r WHERE k <= 8 GROUP BY 1), m AS (SELECT DISTINCT ON (case_id) * FROM cases)
    SELECT m.case_id, concat_ws(' ', case_name || '. ' || coalesce(court, '') || coalesce(', decided ' || strftime(case_date, '%-d %B %Y'), '') || '.',
        CASE WHEN len(array_to_string(citations, '; ')) > 0 THEN 'Citations: ' || array_to_string(citations, '; ') || '.' END,
        CASE WHEN len(array_to_string(bench, ', ')) > 0 THEN 'Bench: ' || array_to_string(bench, ', ') || '.' END,
        CASE WHEN len(regexp_replace(summary, '\\.+$', '')) > 0 THEN regexp_replace(summary, '\\.+$', '') || '.' END,
        CASE WHEN len(provisions) > 0 THEN 'Provisions discussed: ' || provisions || '.' END) AS text FROM m LEFT JOIN t ON m.case_id = t.case_id""")
def pay_cards(spark, sf_dir):
    """Cards of all cases; the roles of their passages stand in for provisions, which these tables hardly cite."""
    from ..operators import cards

    cases = one_per_key(table(spark, sf_dir, "cases"), "case_id")
    roles_ = chunks(spark, sf_dir).where("case_id IS NOT NULL AND rhetorical_role IS NOT NULL").groupBy("case_id", c("rhetorical_role").alias("section")).agg(F.count(F.lit(1)).alias("mentions"), F.min("para_start").alias("first"))
    none = spark.createDataFrame([], "case_id string, first_key string, name_hint string, paragraphs array<int>")
    return cards.cards(cases, roles_.withColumn("code", F.lit("role")), none)


@query("agg_build_figures", f"""
    WITH p AS (SELECT case_id, greatest(1, round_even(len(text) / 4.0, 0))::INT AS tokens FROM {CHUNKS} WHERE text IS NOT NULL AND case_id IS NOT NULL AND rhetorical_role IS NOT NULL)
    SELECT case_id, count(*) AS chunks, min(tokens) AS tokens_min, floor(median(tokens))::INT AS tokens_median, max(tokens) AS tokens_max, count(*) FILTER (WHERE tokens < 25) AS not_substantive FROM p GROUP BY 1""")
def agg_build_figures(spark, sf_dir):
    from ..operators import cards

    p = chunks(spark, sf_dir).where("text IS NOT NULL AND case_id IS NOT NULL AND rhetorical_role IS NOT NULL")
    p = p.select("case_id", c("rhetorical_role").alias("role"), tx.tokens(c("text")).alias("tokens")).withColumn("substantive", c("tokens") >= 25)
    return cards.build_figures(p).drop("roles")


@query("seg_footnotes", "SELECT case_id, '1st note goes on|second' AS notes FROM (SELECT DISTINCT case_id FROM cases WHERE case_id IS NOT NULL)")
def seg_footnotes(spark, sf_dir):
    """Notes joined from the lines of a page's foot, by construction."""
    from ..operators import cards

    lines = F.array(F.lit("stray"), F.lit("1"), F.lit("1st note"), F.lit("goes on"), F.lit("2 second"), F.lit(""))
    return table(spark, sf_dir, "cases").where("case_id IS NOT NULL").select("case_id").distinct().select("case_id", F.array_join(cards.footnotes(lines), "|").alias("notes"))


@query("win_judge_runs")
def win_judge_runs(spark, sf_dir):
    """Runs of pages whose running headers name one judge."""
    from ..operators import reports

    pages = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", c("page_number").alias("page"), "lines"), "page_id")
    return reports.judge_runs(reports.header_names(pages))


@query("agg_case_figures", f"""
    WITH g AS (SELECT case_id, count(DISTINCT page_id) AS pages FROM case_pages WHERE case_id IS NOT NULL GROUP BY 1),
         o AS (SELECT DISTINCT case_id, opinion_index AS segment, numbering FROM opinions WHERE numbering IS NOT NULL),
         n AS (SELECT case_id, CASE WHEN count(DISTINCT numbering) > 1 THEN 'mixed' ELSE max(numbering) END AS para_numbering FROM (SELECT p.case_id, o.numbering FROM (SELECT DISTINCT case_id, segment FROM paragraphs) p JOIN o ON o.case_id = p.case_id AND o.segment = p.segment) GROUP BY 1),
         a AS (SELECT case_id, count(DISTINCT para_id) AS paragraphs, count(DISTINCT segment) AS opinion_segments, count(DISTINCT nullif(heading, '')) AS headings_found FROM paragraphs WHERE case_id IS NOT NULL GROUP BY 1),
         c AS (SELECT *, greatest(1, round_even(len(text) / 4.0, 0))::INT AS t, len(regexp_extract_all(text, '{CITED}')) AS refs FROM {CHUNKS} WHERE text IS NOT NULL AND case_id IS NOT NULL AND rhetorical_role IS NOT NULL),
         f AS (SELECT case_id, count(*) AS chunks, min(t) AS tokens_min, floor(median(t))::INT AS tokens_median, max(t) AS tokens_max, count(*) FILTER (WHERE t < 25) AS not_substantive, sum(refs)::BIGINT AS statutes_cited, count(DISTINCT section_heading) AS blocks FROM c GROUP BY 1),
         r AS (SELECT case_id, string_agg(rhetorical_role || '=' || k, ',' ORDER BY rhetorical_role) AS roles FROM (SELECT case_id, rhetorical_role, count(*) AS k FROM c GROUP BY 1, 2) GROUP BY 1)
    SELECT case_id, coalesce(pages, 0) AS pages, coalesce(paragraphs, 0) AS paragraphs, coalesce(opinion_segments, 0) AS opinion_segments, para_numbering, coalesce(headings_found, 0) AS headings_found, coalesce(chunks, 0) AS chunks, coalesce(tokens_min, 0) AS tokens_min,
           coalesce(tokens_median, 0) AS tokens_median, coalesce(tokens_max, 0) AS tokens_max, coalesce(statutes_cited, 0) AS statutes_cited, coalesce(blocks, 0) AS blocks, coalesce(not_substantive, 0) AS not_substantive, coalesce(roles, '') AS roles
    FROM g FULL JOIN a USING (case_id) FULL JOIN f USING (case_id) LEFT JOIN n USING (case_id) LEFT JOIN r USING (case_id)""")
def agg_case_figures(spark, sf_dir):
    """Figures of each case's build from the stored pages, paragraphs and passages."""
    from ..operators import cards

    pages = table(spark, sf_dir, "case_pages").where("case_id IS NOT NULL").select("case_id", "page_id")
    numbered = table(spark, sf_dir, "opinions").where("numbering IS NOT NULL").select("case_id", c("opinion_index").alias("segment"), "numbering").distinct()
    paras = table(spark, sf_dir, "paragraphs").where("case_id IS NOT NULL").select("case_id", "para_id", "segment", "heading").join(numbered, ["case_id", "segment"], "left")
    p = chunks(spark, sf_dir).where("text IS NOT NULL AND case_id IS NOT NULL AND rhetorical_role IS NOT NULL")
    p = p.select("case_id", c("rhetorical_role").alias("role"), tx.tokens(c("text")).alias("tokens"), c("section_heading").alias("block_id"), F.regexp_extract_all("text", F.lit(CITED), F.lit(0)).alias("statutes"), F.array().cast("array<string>").alias("cited_cases"))
    found = cards.case_figures(pages, paras, p.withColumn("substantive", c("tokens") >= 25))
    roles_ = F.array_join(F.transform(F.map_entries("roles"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return found.withColumn("roles", F.coalesce(roles_, F.lit(""))).drop("cases_cited")
