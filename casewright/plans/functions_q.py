"""Queries of the scalar functions over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, maths
from ..functions import text as tx
from ..operators import records
from ..sources.tables import one_per_key, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def over(name: str, source: str, key: str, out, sql_out: dict[str, str], where: str = "true") -> None:
    """A query that computes columns of each distinct row of a table, and its SQL."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return one_per_key(table(spark, sf_dir, source), key).where(where).select(F.col(key).alias("id"), *[c.alias(n) for n, c in out().items()])

    cols = ", ".join(f"{e} AS {n}" for n, e in sql_out.items())
    QUERIES[name] = run
    if sql_out:
        ORACLES[name] = f"SELECT id, {', '.join(sql_out)} FROM (SELECT DISTINCT ON ({key}) {key} AS id, {cols} FROM {source} WHERE {key} IS NOT NULL AND ({where}))"


c = F.col
SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"
over("fn_slug", "cases", "case_id", lambda: {"slug": ids.slug(c("case_name")), "key": ids.citation_key(c("case_number"))},
     {"slug": SLUG.format("case_name"), "key": "trim(regexp_replace(lower(case_number), '[^a-z0-9]+', '-', 'g'), '-')"})
over("fn_judge_slug", "opinions", "opinion_id", lambda: {"judge": ids.judge_slug(c("author"))},
     {"judge": SLUG.format("regexp_replace(author, '\\b(hon''?ble|justice|mr|mrs|ms|dr|cji|c\\.j\\.i|chief justice of india|chief justice|jj?)\\b\\.?', ' ', 'gi')")})
over("fn_parent_id", "chunks", "chunk_id", lambda: {"parent": ids.parent_id(c("chunk_id")), "sha": F.sha2("text", 256)},
     {"parent": "regexp_replace(chunk_id, '_\\d+$', '')", "sha": "sha256(text)"})
NS = ids.POINTS.hex
H = f"sha1(unhex('{NS}') || encode(chunk_id))"
over("fn_point_id", "chunks", "chunk_id", lambda: {"point": ids.point_id(c("chunk_id"))},
     {"point": f"{H}[1:8] || '-' || {H}[9:12] || '-5' || {H}[14:16] || '-' || substr('89ab', 1 + (strpos('0123456789abcdef', {H}[17:17]) - 1) % 4, 1) || {H}[18:20] || '-' || {H}[21:32]"})
TOK = "greatest(1, round_even(len(text) / 4.0, 0))::INT"
over("fn_tokens", "paragraphs", "para_id", lambda: {"tokens": tx.tokens(c("text")), "chars": F.length("text")}, {"tokens": f"CASE WHEN text IS NULL THEN 1 ELSE {TOK} END", "chars": "len(text)::INT"})
over("fn_quoted_share", "chunks", "chunk_id", lambda: {"quoted": tx.quoted_share(c("text"))},
     {"quoted": "CASE WHEN coalesce(len(text), 0) = 0 THEN 0.0 ELSE coalesce(round(least(1.0, coalesce(list_sum(list_transform(regexp_extract_all(text, '“[^”]*(?:”|$)|\"[^\"]*(?:\"|$)'), lambda x: len(x))), 0)::DOUBLE / nullif(len(text), 0)), 2), 0.0) END"})
over("fn_caps_share", "paragraphs", "para_id", lambda: {"caps": F.round(tx.caps_share(c("text")), 6)},
     {"caps": "CASE WHEN text IS NULL THEN 0.0 ELSE round(coalesce(len(regexp_replace(text, '[^\\p{Lu}]', '', 'g'))::DOUBLE / nullif(len(regexp_replace(text, '[^\\p{L}]', '', 'g')), 0), 0.0), 6) END"})
over("fn_surname", "judges", "judge_id", lambda: {"surname": tx.surname(c("full_name"))}, {"surname": "regexp_replace(lower(string_split(full_name, ' ')[-1]), '[^a-z]', '', 'g')"})
STATE_SQL = "regexp_matches({0}, '(State|Union( of India)?|Revenue|prosecution|Government|C\\.?B\\.?I\\.?)([^a-z]|$)')"
FIRST, SECOND = "regexp_replace(case_name, '(?i)\\s+(v\\.?|vs\\.?|versus)\\s.*$', '')", "regexp_extract(case_name, '(?i)^.*?\\s+(?:v\\.?|vs\\.?|versus)\\s+(.*)$', 1)"
over("fn_state_side", "cases", "case_id", lambda: {"side": tx.state_side(c("case_name"))},
     {"side": f"CASE WHEN {STATE_SQL.format(FIRST)} AND NOT {STATE_SQL.format(SECOND)} THEN 'petitioner' WHEN {STATE_SQL.format(SECOND)} AND NOT {STATE_SQL.format(FIRST)} THEN 'respondent' END"})
HEAD = " ".join(
    f"WHEN regexp_matches(heading, '{p}') THEN " + (f"CASE WHEN regexp_matches(heading, '{tx.PETITIONER}') THEN 'argument_petitioner' WHEN regexp_matches(heading, '{tx.RESPONDENT}') THEN 'argument_respondent' ELSE 'argument' END" if r == "argument" else f"'{r}'")
    for p, r in tx.HEADING_KINDS
)
over("fn_heading_role", "paragraphs", "para_id", lambda: {"role": tx.heading_role(c("heading"), F.lit(None).cast("string"))}, {"role": f"CASE WHEN heading IS NULL OR heading = '' THEN NULL {HEAD} END"})
DATE = "strftime({0}, '%-d %B %Y')"
over("fn_context_line", "cases", "case_id",
     lambda: {"context": tx.context_line(c("case_name"), c("court"), tx.date_words(c("case_date")), F.get(c("citations"), F.lit(0)), c("summary"), c("layout"))},
     {"context": f"concat_ws(', ', nullif(case_name, ''), nullif(court, ''), {DATE.format('case_date')}, nullif(citations[1], '')) || '.' || coalesce(' ' || regexp_replace(trim(nullif(summary, '')), '\\.+$', '') || '.', '') || coalesce(' Section: ' || nullif(layout, '') || '.', '')"})
over("fn_cite_as", "cases", "case_id",
     lambda: {"cite": tx.cite_as(c("case_name"), F.get(c("citations"), F.lit(0)), c("case_date"), F.lit("original"), F.lit(3), c("layout"), F.get(c("bench"), F.lit(0)), F.lit("unknown"), F.size("bench") > 2)},
     {"cite": f"case_name || coalesce(', ' || nullif(citations[1], ''), ', decided ' || {DATE.format('case_date')}, '') || CASE WHEN layout LIKE '%-%' THEN ', paras ' || layout ELSE ', para ' || layout END || CASE WHEN len(bench) > 2 AND bench[1] IS NOT NULL THEN ' (per ' || bench[1] || ')' ELSE '' END"})
over("fn_dates", "judgment_sample", "file", lambda: {"iso": dates.iso_date(c("decision_date")), "era": dates.era(c("decision_year")), "pages": dates.pages_of(c("path")), "length": dates.length_class(c("pages")), "criminal": dates.is_criminal(c("case_number"))},
     {"iso": "coalesce(regexp_replace(trim(decision_date), '^(\\d{2})-(\\d{2})-(\\d{4})$', '\\3-\\2-\\1'), '')",
      "era": "CASE WHEN decision_year BETWEEN 1950 AND 1989 THEN '1950-1989' WHEN decision_year BETWEEN 1990 AND 2009 THEN '1990-2009' WHEN decision_year BETWEEN 2010 AND 2025 THEN '2010-2025' END",
      "pages": "coalesce(greatest(1, regexp_extract_all(path, '\\d+')[-1]::BIGINT - regexp_extract_all(path, '\\d+')[-2]::BIGINT + 1), 1)::INT",
      "length": "CASE WHEN pages <= 8 THEN 'short' WHEN pages >= 40 THEN 'long' ELSE 'medium' END",
      "criminal": "coalesce(regexp_matches(case_number, '(?i)\\bCRIMINAL\\b|\\bCRL\\b'), false)"})
over("fn_parse_date", "judgment_sample", "file",
     lambda: {"day": dates.parse_date(F.concat(F.lit("decided on "), F.date_format(F.try_to_date(dates.iso_date(c("decision_date"))), "d'th day of' MMMM, yyyy"), F.lit(" at 10"))).cast("string"),
      "month_first": dates.parse_date(F.date_format(F.try_to_date(dates.iso_date(c("decision_date"))), "MMM d, yyyy")).cast("string"),
      "numeric": dates.parse_date(F.date_format(F.try_to_date(dates.iso_date(c("decision_date"))), "dd.MM.yyyy")).cast("string")},
     {k: "try_cast(coalesce(regexp_replace(trim(decision_date), '^(\\d{2})-(\\d{2})-(\\d{4})$', '\\3-\\2-\\1'), '') AS DATE)::VARCHAR" for k in ("day", "month_first", "numeric")})
over("fn_join_lines", "law_reports", "case_id", lambda: {"text": tx.join_lines(F.split("header", "\n"))},
     {"text": "trim(regexp_replace(array_to_string(list_filter(list_transform(string_split(header, chr(10)), lambda x: trim(x)), lambda x: x <> ''), ' '), '\\s+', ' ', 'g'))"})
over("fn_strip_html", "paragraphs", "para_id", lambda: {"text": tx.strip_html(F.concat(F.lit("<p class='x'>"), c("label"), F.lit("<br/> <b>"), c("heading"), F.lit("</b></p>")))},
     {"text": "trim(regexp_replace(label || ' ' || heading, '\\s+', ' ', 'g'))"})
SPELLINGS = "".join(rf" \{first}{digits}" for first in ("", "0", "2") for digits in tx.ESCAPES) + r"\05\205\8\x " + "".join(tx.GLYPHS)
TIDY = "translate({}, '" + "".join(tx.GLYPHS) + "', '" + "".join(tx.GLYPHS.values()) + "')"
for _digits, _mark in tx.ESCAPES.items():
    TIDY = f"regexp_replace({TIDY}, '{tx.escape_pattern(_digits)}', '{_mark}', 'g')"
WRITTEN = f"(array_to_string(lines, chr(10)) || '{SPELLINGS}')"
over("fn_tidy", "case_pages", "page_id", lambda: {"text": tx.tidy(F.concat(F.array_join("lines", "\n"), F.lit(SPELLINGS))), "escapes": tx.escapes(F.concat(F.array_join("lines", "\n"), F.lit(SPELLINGS)))},
     {"text": TIDY.replace("{}", WRITTEN), "escapes": f"len(regexp_extract_all({WRITTEN}, '{'|'.join(map(tx.escape_pattern, tx.ESCAPES))}'))::INT"})
over("fn_embedding_text", "chunks", "chunk_id", lambda: {"text": tx.embedding_text(c("section_heading"), c("text"))},
     {"text": "CASE WHEN coalesce(section_heading, '') <> '' THEN section_heading || chr(10) || chr(10) || text ELSE text END"})
over("fn_state_case_id", "judgment_sample", "file",
     lambda: {"case_id": ids.case_slug(F.trim(F.split(c("title"), " versus ")[0]), F.trim(F.get(F.split(c("title"), " versus "), F.lit(1))), c("decision_year"), c("file"))},
     {"case_id": "array_to_string(string_split(" + SLUG.format("regexp_replace(regexp_replace(CASE WHEN regexp_matches(trim(string_split(title, ' versus ')[1]), '(?i)^(state|union|commissioner|director|collector)\\b') THEN trim(string_split(title, ' versus ')[1]) || ' v ' || trim(string_split(title, ' versus ')[2]) ELSE trim(string_split(title, ' versus ')[1]) END, '(?i)^(justice|dr|shri|smt|mr|mrs|ms|m/s|his holiness|sri)\\.?\\s+', ''), '\\(.*?\\)', '', 'g')") + ", '_')[1:6], '_') || coalesce('_' || decision_year, '')"}, where="title IS NOT NULL")

KNOWN = ["submissions of the appellant", "the statutory scheme", "conclusion", "analysis", "facts"]
over("fn_letters", "cases", "case_id", lambda: {"letters": tx.letters(c("case_name"))}, {"letters": "regexp_replace(lower(case_name), '[^a-z]', '', 'g')"})
HKEY = "trim(regexp_replace(lower(heading), '[^a-z0-9]+', ' ', 'g'))"
over("fn_known_heading", "paragraphs", "para_id", lambda: {"known": tx.known_heading(c("heading"), F.array(*[F.lit(k) for k in KNOWN]))},
     {"known": f"coalesce({HKEY} <> '' AND len(list_filter({KNOWN}, lambda k: k = {HKEY} OR (len({HKEY}) >= 12 AND len(k) >= 12 AND (starts_with(k, {HKEY}) OR starts_with({HKEY}, k))))) > 0, false)"})
over("fn_header_judge", "case_pages", "page_id", lambda: {"judge": tx.header_judge(F.get("lines", F.lit(0)))},
     {"judge": "trim(nullif(CASE WHEN regexp_matches(regexp_extract(lines[1], '" + tx.HEADER_JUDGE + "', 1), '" + tx.NO_HEADER_JUDGE + "') THEN NULL ELSE regexp_extract(lines[1], '" + tx.HEADER_JUDGE + "', 1) END, ''))"})
over("fn_report_header", "case_pages", "page_id", lambda: {"report": tx.report_header(F.get("lines", F.lit(0)))}, {})
over("fn_date_line", "law_reports", "case_id", lambda: {"dates": F.array_join(F.transform(F.array_compact(F.transform(F.split("header", "\n"), lambda x: dates.date_line(dates.repaired_year(x)))), lambda d: d.cast("string")), ",")}, {})
over("rec_html", "judgment_sample", "file",
     lambda: {"bench": F.array_join(c("h.bench"), "; "), "author": c("h.author"), "case_number": c("h.case_number"), "bench_size": c("h.bench_size")},
     {"bench": "array_to_string(list_filter(list_transform(string_split(coalesce(replace(bench, ';', ','), ''), ','), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), '; ')",
      "author": "nullif(trim(regexp_replace(string_split(replace(bench, ';', ','), ',')[1], '\\s+', ' ', 'g')), '')", "case_number": "nullif(trim(regexp_replace(case_number, '\\s+', ' ', 'g')), '')", "bench_size": "bench_size"})


def rec_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields read back from records' pages, which are written here from the stored fields, as no table holds pages."""
    s = one_per_key(table(spark, sf_dir, "judgment_sample"), "file")
    some = lambda x: F.coalesce(x, F.lit(""))
    coram = F.regexp_replace(F.replace(some(c("bench")), F.lit(";"), F.lit(",")), "^([^,]+)", "<b>$1</b>*")
    html = F.concat(
        F.lit("<strong>Coram : "), coram, F.lit("</strong><span>Case No :</span><font size=2> "), some(c("case_number")), F.lit("</font><span>Bench :</span><font> "), some(c("bench_size").cast("string")), F.lit("</font>")
    )
    rows = s.select(c("file").alias("id"), records.html_fields(html).alias("h"))
    return rows.select("id", F.array_join("h.bench", "; ").alias("bench"), "h.author", "h.case_number", "h.bench_size")


QUERIES["rec_html"] = rec_html

# built by construction: both engines write the text, Spark must read it
N = "hash_n"


@query("fn_section", "SELECT doc_id, (doc_id % 511 + 1) || 'A(' || (doc_id % 7) || ')' AS section, (doc_id % 511 + 1) || 'A' AS base, 'IPC:' || (doc_id % 511 + 1) || 'A(' || (doc_id % 7) || ')' AS statute FROM documents")
def fn_section(spark, sf_dir):
    raw = F.concat((c("doc_id") % 511 + 1).cast("string"), F.lit(" - a ("), (c("doc_id") % 7).cast("string"), F.lit(") "))
    return table(spark, sf_dir, "documents").select("doc_id", ids.section(raw).alias("section"), ids.base_section(raw).alias("base"), ids.statute_id(F.lit("IPC"), raw).alias("statute"))


@query("fn_repair_digits", "SELECT doc_id, 'Section 30' || (doc_id % 9 + 1) || 'A and 1' || (doc_id % 10) || '1 2' AS text FROM documents")
def fn_repair_digits(spark, sf_dir):
    raw = F.concat(F.lit("Section 3O"), (c("doc_id") % 9 + 1).cast("string"), F.lit("A and 1"), (c("doc_id") % 10).cast("string"), F.lit("1 2"))
    wrong = F.regexp_replace(raw, r"and 1(\d)1", "and 1$1l7").alias("w")
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(tx.repair_digits(wrong), "17 2$", "1 2").alias("text"))


@query("fn_sentences", "SELECT doc_id, 3::INT AS n, 'The claim of Mr. R. Rao v. State is No. ' || (doc_id % 9) || ' here.' AS second FROM documents")
def fn_sentences(spark, sf_dir):
    raw = F.concat(F.lit("Leave granted. The claim of Mr. R. Rao v. State is No. "), (c("doc_id") % 9).cast("string"), F.lit(" here. It is dismissed."))
    s = tx.sentences(raw)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n"), F.element_at(s, 2).alias("second"))


@query("fn_title_case", "SELECT judge_id, full_name AS name FROM judges")
def fn_title_case(spark, sf_dir):
    return table(spark, sf_dir, "judges").select("judge_id", tx.title_case(F.upper("full_name")).alias("name"))


@query("fn_clean_judge", "SELECT judge_id, full_name AS name FROM judges")
def fn_clean_judge(spark, sf_dir):
    return table(spark, sf_dir, "judges").select("judge_id", tx.clean_judge(F.concat(F.lit("[Hon’ble Mr. Justice "), "full_name", F.lit(", J.]"))).alias("name"))


@query("fn_clean_party", "SELECT judge_id, full_name AS name FROM judges")
def fn_clean_party(spark, sf_dir):
    return table(spark, sf_dir, "judges").select("judge_id", tx.clean_party(F.concat(F.upper("full_name"), F.lit(" & ORS. ...APPELLANTS"))).alias("name"))


@query("fn_headings", "SELECT DISTINCT heading, len(heading) >= 3 AS is_heading, heading AS cleaned FROM paragraphs WHERE heading IS NOT NULL AND heading <> ''")
def fn_headings(spark, sf_dir):
    rows = table(spark, sf_dir, "paragraphs").where("heading IS NOT NULL AND heading <> ''").select("heading").distinct()
    return rows.select("heading", tx.is_heading(c("heading")).alias("is_heading"), tx.clean_heading(F.concat(F.lit("["), "heading", F.lit("] :"))).alias("cleaned"))


@query("fn_same_judge", "SELECT judge_id, true AS same, false AS other FROM judges")
def fn_same_judge(spark, sf_dir):
    return table(spark, sf_dir, "judges").select(
        "judge_id", tx.same_surname(c("full_name"), F.concat(F.lit("J. "), "full_name", F.lit("e"))).alias("same"), tx.same_surname(c("full_name"), F.lit("A. Xyqqx")).alias("other")
    )


@query("fn_dot", """
    SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS square FROM embeddings""")
def fn_dot(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(maths.dot(c("embedding"), c("embedding")), 4).alias("square"))


@query("fn_quotas", """
    WITH r AS (SELECT source, 101 * target_share AS raw FROM mix_targets),
         b AS (SELECT source, floor(raw)::BIGINT AS base, raw - floor(raw) AS rest FROM r),
         k AS (SELECT *, row_number() OVER (ORDER BY rest DESC, source) AS n FROM b)
    SELECT source, base + (n <= 101 - (SELECT sum(base) FROM b))::BIGINT AS quota FROM k""")
def fn_quotas(spark, sf_dir):
    return maths.quotas(table(spark, sf_dir, "mix_targets"), "source", "target_share", 101)
