"""Queries of joins, windows, aggregates, graph, search and sampling, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, ids
from ..functions import text as tx
from ..operators import extract, graph, mapping, quality, sampling, sequences, vectors
from ..sources.tables import checkpointed, one_per_key, table

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


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_key(table(spark, sf_dir, "chunks"), "chunk_id")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_key(table(spark, sf_dir, "paragraphs"), "para_id")


CHUNKS = "(SELECT DISTINCT ON (chunk_id) * FROM chunks WHERE chunk_id IS NOT NULL)"
PARAS = "(SELECT DISTINCT ON (para_id) * FROM paragraphs WHERE para_id IS NOT NULL)"
ORDER = "segment, para_start, chunk_part, chunk_id"
SEQ = ["segment", "para_start", "chunk_part", "chunk_id"]

#: Rows of a mapping table for examples and tests; a full one is read from files.
EXAMPLES = [
    ("IPC", "34", "BNS", "3(5)", "unreviewed", "Common intention", None, "2024-07-01", "gazette", "yes"),
    ("IPC", "302", "BNS", "103(1)", "unreviewed", "Murder", None, "2024-07-01", "gazette", "yes"),
    ("IPC", "304A", "BNS", "106(1)", "modified", "Death by negligence", "second class of cases added", "2024-07-01", "gazette", "yes"),
    ("IPC", "376", "BNS", "64", "unreviewed", "Rape", None, "2024-07-01", "gazette", "no"),
    ("IPC", "377", None, None, "omitted", "Unnatural offences", "not carried over", "2024-07-01", "gazette", "yes"),
    ("IPC", "506", "BNS", "351(2)", "split", "Criminal intimidation", None, "2024-07-01", "gazette", "yes"),
    ("IPC", "506", "BNS", "351(3)", "split", "Criminal intimidation", None, "2024-07-01", "gazette", "yes"),
    ("CrPC", "154", "BNSS", "173", "modified", "Information in cognizable cases", "electronic information", "2024-07-01", "gazette", "yes"),
    ("CrPC", "482", "BNSS", "528", "unreviewed", "Inherent powers", None, "2024-07-01", "gazette", "no"),
]


def examples(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame(EXAMPLES, ", ".join(f"{x} string" for x in mapping.COLUMNS))
    return mapping.normalized(raw.coalesce(1))


@query("win_neighbours", f"SELECT chunk_id, lag(chunk_id) OVER w AS prev_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM {CHUNKS} WINDOW w AS (PARTITION BY case_id ORDER BY {ORDER})")
def win_neighbours(spark, sf_dir):
    return sequences.neighbours(chunks(spark, sf_dir).select("case_id", *SEQ), "case_id", SEQ, "chunk_id").select("chunk_id", "prev_chunk_id", "next_chunk_id")


@query("win_blocks", f"""
    WITH m AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR segment IS DISTINCT FROM lag(segment) OVER w OR rhetorical_role IS DISTINCT FROM lag(rhetorical_role) OVER w
                 OR section_heading IS DISTINCT FROM lag(section_heading) OVER w THEN 1 ELSE 0 END AS change FROM {CHUNKS} WINDOW w AS (PARTITION BY case_id ORDER BY {ORDER})),
         b AS (SELECT *, sum(change) OVER (PARTITION BY case_id ORDER BY {ORDER}) - 1 AS block FROM m)
    SELECT chunk_id, case_id || '_b' || block::BIGINT AS block_id, row_number() OVER (PARTITION BY case_id, block ORDER BY {ORDER}) - 1 AS block_index FROM b""")
def win_blocks(spark, sf_dir):
    df = chunks(spark, sf_dir).select("case_id", *SEQ, "rhetorical_role", "section_heading")
    return sequences.blocks(df, "case_id", SEQ, ["segment", "rhetorical_role", "section_heading"]).select("chunk_id", "block_id", "block_index")


@query("win_near_end", f"""
    SELECT para_id, (count(*) OVER (PARTITION BY case_id, segment) - row_number() OVER (PARTITION BY case_id, segment ORDER BY para_seq, para_id))
        < greatest(6, round_even(count(*) OVER (PARTITION BY case_id, segment) * 0.12, 0)) AS near_end FROM {PARAS}""")
def win_near_end(spark, sf_dir):
    df = paragraphs(spark, sf_dir).select("para_id", "case_id", "segment", "para_seq")
    return sequences.near_end(df, ["case_id", "segment"], ["para_seq", "para_id"]).select("para_id", "near_end")


@query("win_number_gaps", f"""
    WITH s AS (SELECT case_id, segment, min(number) AS a, max(number) AS z, list(DISTINCT number) AS have FROM {PARAS} WHERE number IS NOT NULL GROUP BY 1, 2),
         g AS (SELECT case_id, segment, list_filter(range(a, z + 1), lambda x: NOT list_contains(have, x::INT)) AS gone FROM s)
    SELECT case_id, segment, len(gone)::BIGINT AS missing, array_to_string(gone[1:6], ',') AS first FROM g WHERE len(gone) > 0""")
def win_number_gaps(spark, sf_dir):
    gaps = sequences.number_gaps(paragraphs(spark, sf_dir), ["case_id", "segment"], "number")
    return gaps.select("case_id", "segment", "missing", F.array_join("first", ",").alias("first"))


NOTES = "(SELECT DISTINCT ON (page_id) page_id, case_id, page_number, footnotes FROM case_pages WHERE page_id IS NOT NULL)"


@query("jn_notes", f"""
    WITH n AS (SELECT case_id, page_number AS page, generate_subscripts(footnotes, 1) - 1 AS note_seq FROM {NOTES}),
         p AS (SELECT case_id, page, arg_max(para_id, struct_pack(s := para_seq, i := para_id)) AS para_id FROM {PARAS} GROUP BY 1, 2)
    SELECT n.case_id, n.page, n.note_seq::INT AS note_seq, p.para_id FROM n ASOF LEFT JOIN p ON n.case_id = p.case_id AND n.page >= p.page""")
def jn_notes(spark, sf_dir):
    pages = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", "page_number", "footnotes"), "page_id")
    notes = pages.select("case_id", c("page_number").alias("page"), F.posexplode("footnotes").alias("note_seq", "note"))
    paras = paragraphs(spark, sf_dir).groupBy("case_id", "page").agg(F.max(F.struct("para_seq", "para_id")).alias("x")).select("case_id", "page", "x.*")
    return sequences.notes_to_paragraphs(notes, paras).select("case_id", "page", "note_seq", "para_id")


@query("agg_sizes", f"""
    SELECT case_id, count(tokens) AS n, min(tokens) AS least, floor(median(tokens))::INT AS middle, list_sort(list(tokens))[count(tokens) // 2 + 1] AS upper, max(tokens) AS most
    FROM {CHUNKS} WHERE tokens IS NOT NULL GROUP BY 1""")
def agg_sizes(spark, sf_dir):
    return quality.sizes(chunks(spark, sf_dir).select("case_id", "chunk_id", "tokens"), "case_id", "tokens")


@query("agg_numbering", f"SELECT case_id, count(*) AS opinions, CASE WHEN count(DISTINCT numbering) > 1 THEN 'mixed' ELSE min(numbering) END AS numbering FROM (SELECT DISTINCT ON (opinion_id) * FROM opinions) GROUP BY 1")
def agg_numbering(spark, sf_dir):
    rows = one_per_key(table(spark, sf_dir, "opinions").select("opinion_id", "case_id", "numbering"), "opinion_id")
    return rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("opinions"), F.when(F.count_distinct("numbering") > 1, "mixed").otherwise(F.min("numbering")).alias("numbering"))


@query("agg_running_headers", r"""
    WITH p AS (SELECT DISTINCT ON (page_id) page_id, case_id, lines FROM case_pages WHERE page_id IS NOT NULL),
         e AS (SELECT page_id, case_id, unnest(list_distinct(lines[1:2] || lines[-2:])) AS line FROM p),
         s AS (SELECT case_id, regexp_replace(trim(line), '\d+', '#', 'g') AS shape, count(DISTINCT page_id) AS pages FROM e WHERE line IS NOT NULL GROUP BY 1, 2),
         n AS (SELECT case_id, count(*) AS total FROM p GROUP BY 1)
    SELECT case_id, shape, pages FROM s JOIN n USING (case_id) WHERE total >= 3 AND len(shape) > 3 AND pages >= greatest(3, 0.6 * total)""")
def agg_running_headers(spark, sf_dir):
    """Lines at page edges that recur, digits masked, on most pages of a case."""
    p = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", "lines"), "page_id")
    edges = p.select("page_id", "case_id", F.explode(F.array_distinct(F.concat(F.slice("lines", 1, 2), F.slice("lines", F.greatest(F.lit(1), F.size("lines") - 1), F.lit(2))))).alias("line"))
    shape = F.regexp_replace(F.trim("line"), r"\d+", "#")
    seen = edges.where("line IS NOT NULL").select("case_id", "page_id", shape.alias("shape")).distinct().groupBy("case_id", "shape").agg(F.count(F.lit(1)).alias("pages"))
    total = p.groupBy("case_id").agg(F.count(F.lit(1)).alias("total"))
    return seen.join(total, "case_id").where((c("total") >= 3) & (F.length("shape") > 3) & (c("pages") >= F.greatest(F.lit(3.0), c("total") * 0.6))).select("case_id", "shape", "pages")


@query("agg_modal_margin", """
    WITH p AS (SELECT DISTINCT ON (page_id) page_id, case_id, x0 FROM case_pages WHERE page_id IS NOT NULL), x AS (SELECT case_id, unnest(x0) AS x FROM p),
         n AS (SELECT case_id, x, count(*) AS n FROM x WHERE x IS NOT NULL GROUP BY 1, 2)
    SELECT DISTINCT ON (case_id) case_id, x AS margin, n FROM n ORDER BY case_id, n DESC, x""")
def agg_modal_margin(spark, sf_dir):
    p = one_per_key(table(spark, sf_dir, "case_pages").select("page_id", "case_id", "x0"), "page_id")
    n = p.select("case_id", F.explode("x0").alias("x")).where("x IS NOT NULL").groupBy("case_id", "x").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("case_id").agg(F.max(F.struct(c("n"), (-c("x")).alias("m"))).alias("t")).select("case_id", (-c("t.m")).alias("margin"), c("t.n").alias("n"))


W = "unnest(regexp_extract_all(lower(text), '[A-Za-z0-9]+'))"


@query("set_words_lost", f"""
    WITH a AS (SELECT case_id, word, count(*) AS n FROM (SELECT case_id, {W} AS word FROM {PARAS}) GROUP BY 1, 2),
         b AS (SELECT case_id, word, count(*) AS n FROM (SELECT case_id, {W} AS word FROM {CHUNKS}) GROUP BY 1, 2)
    SELECT a.case_id, sum(a.n)::BIGINT AS total, sum(greatest(a.n - coalesce(b.n, 0), 0))::BIGINT AS lost FROM a LEFT JOIN b ON a.case_id = b.case_id AND a.word = b.word GROUP BY 1""")
def set_words_lost(spark, sf_dir):
    """Words of each case's paragraphs that did not reach its chunks."""
    a, b = quality.word_counts(paragraphs(spark, sf_dir), "case_id", "text"), quality.word_counts(chunks(spark, sf_dir), "case_id", "text")
    return quality.words_lost(a, b, "case_id")


@query("flt_substantive", f"""
    SELECT chunk_id, rhetorical_role = 'ruling' OR (NOT regexp_matches(text, '(?i)^\\W*\\d*\\W*(leave granted|delay condoned|issue notice)\\b[^.]*\\.?\\s*$') AND greatest(1, round_even(len(text) / 4.0, 0)) >= 25) AS substantive
    FROM {CHUNKS} WHERE text IS NOT NULL AND rhetorical_role IS NOT NULL""")
def flt_substantive(spark, sf_dir):
    plain = c("text").rlike(r"(?i)^\W*\d*\W*(leave granted|delay condoned|issue notice)\b[^.]*\.?\s*$")
    keep = (c("rhetorical_role") == "ruling") | (~plain & (tx.tokens(c("text")) >= 25))
    return chunks(spark, sf_dir).where("text IS NOT NULL AND rhetorical_role IS NOT NULL").select("chunk_id", keep.alias("substantive"))


@query("top_parent_cap", f"""
    WITH p AS (SELECT *, regexp_replace(chunk_id, '_\\d+$', '') AS parent_id FROM {CHUNKS}),
         f AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY tokens DESC NULLS LAST, chunk_id) AS a FROM p),
         k AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY tokens DESC NULLS LAST, chunk_id) AS b FROM f WHERE a = 1)
    SELECT case_id, chunk_id, parent_id FROM k WHERE b <= 3""")
def top_parent_cap(spark, sf_dir):
    """The three largest chunks of each case, one of each parent (a top-k report)."""
    from pyspark.sql.window import Window

    p = chunks(spark, sf_dir).select("case_id", "chunk_id", "tokens", ids.parent_id(c("chunk_id")).alias("parent_id"))
    order = [F.desc_nulls_last("tokens"), "chunk_id"]
    one = p.withColumn("a", F.row_number().over(Window.partitionBy("parent_id").orderBy(*order))).where("a = 1")
    return one.withColumn("b", F.row_number().over(Window.partitionBy("case_id").orderBy(*order))).where("b <= 3").select("case_id", "chunk_id", "parent_id")


@query("gr_bench", """
    WITH f AS (SELECT case_id, unnest(bench) AS name FROM cases),
         j AS (SELECT case_id, name, trim(regexp_replace(lower(regexp_replace(name, '\\b(hon''?ble|justice|mr|mrs|ms|dr|cji|c\\.j\\.i|chief justice of india|chief justice|jj?)\\b\\.?', ' ', 'gi')), '[^a-z0-9]+', '_', 'g'), '_') AS judge_id FROM f)
    SELECT case_id, judge_id, min(name) AS name FROM j WHERE judge_id <> '' GROUP BY 1, 2""")
def gr_bench(spark, sf_dir):
    return graph.bench_edges(one_per_key(table(spark, sf_dir, "cases"), "case_id"))


@query("gr_authors", """
    WITH j AS (SELECT DISTINCT case_id, opinion_index, opinion_type AS type, trim(regexp_replace(lower(regexp_replace(author, '\\b(hon''?ble|justice|mr|mrs|ms|dr|cji|c\\.j\\.i|chief justice of india|chief justice|jj?)\\b\\.?', ' ', 'gi')), '[^a-z0-9]+', '_', 'g'), '_') AS judge_id FROM opinions)
    SELECT case_id, opinion_index, judge_id, type FROM j WHERE judge_id <> ''""")
def gr_authors(spark, sf_dir):
    return graph.author_edges(table(spark, sf_dir, "opinions"))


KEY = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"


@query("gr_citation_nodes", f"SELECT {KEY.format('x')} AS key, count(DISTINCT case_id) AS cases FROM (SELECT case_id, unnest(citations) AS x FROM cases) GROUP BY 1")
def gr_citation_nodes(spark, sf_dir):
    flat = table(spark, sf_dir, "cases").select("case_id", F.explode("citations").alias("x")).select("case_id", ids.citation_key(c("x")).alias("key"))
    return flat.groupBy("key").agg(F.count_distinct("case_id").alias("cases"))


@query("gr_overrules", f"""
    WITH k AS (SELECT {KEY.format('x')} AS key, min(case_id) AS target FROM (SELECT case_id, unnest(citations) AS x FROM cases) GROUP BY 1),
         o AS (SELECT DISTINCT case_id, {KEY.format('x')} AS key FROM (SELECT case_id, unnest(overrules) AS x FROM cases))
    SELECT DISTINCT o.case_id, coalesce(k.target, 'cite:' || o.key) AS target FROM o LEFT JOIN k USING (key) WHERE coalesce(k.target, 'cite:' || o.key) <> o.case_id""")
def gr_overrules(spark, sf_dir):
    """Overruled cases resolved to loaded ones or stubs."""
    cases = one_per_key(table(spark, sf_dir, "cases").select("case_id", "citations", "overrules"), "case_id")
    keyed = cases.select("case_id", F.transform("citations", ids.citation_key).alias("keys"))
    cited = cases.select("case_id", F.explode("overrules").alias("x")).select("case_id", F.array(ids.citation_key(c("x"))).alias("keys"), F.array().cast("array<int>").alias("paragraphs")).distinct()
    edges = graph.resolve(cited, keyed)
    named = cited.select("case_id", c("keys")[0].alias("key"))
    return graph.overrules(edges, named)


@query("gr_unique", "SELECT 'case' AS label, count(DISTINCT case_id) AS n FROM cases UNION ALL SELECT 'judge', count(DISTINCT judge_id) FROM judges")
def gr_unique(spark, sf_dir):
    return graph.node_counts({"case": (table(spark, sf_dir, "cases"), "case_id"), "judge": (table(spark, sf_dir, "judges"), "judge_id")})


@query("snk_upsert", "SELECT case_id, arg_max(summary, struct_pack(t := updated_at, k := k)) AS summary FROM (SELECT case_id, coalesce(summary, '') AS summary, updated_at, 0 AS k FROM cases UNION ALL SELECT case_id, coalesce(summary, ''), updated_at, 1 FROM cases_copy) GROUP BY 1")
def snk_upsert(spark, sf_dir):
    a, b = (table(spark, sf_dir, t).select("case_id", F.coalesce("summary", F.lit("")).alias("summary"), "updated_at") for t in ("cases", "cases_copy"))
    return graph.upsert(a, b, "case_id", "updated_at").select("case_id", "summary")


@query("snk_replace_case", "SELECT chunk_id, case_id FROM chunks WHERE case_id NOT IN (SELECT case_id FROM law_reports WHERE case_id IS NOT NULL) UNION ALL SELECT 'report', case_id FROM law_reports")
def snk_replace_case(spark, sf_dir):
    new = table(spark, sf_dir, "law_reports").select(F.lit("report").alias("chunk_id"), "case_id")
    return graph.replace_case(table(spark, sf_dir, "chunks").select("chunk_id", "case_id"), new)


@query("srch_duplicates", "SELECT DISTINCT a.doc_id FROM documents a JOIN documents b ON sha256(a.text) = sha256(b.text) AND a.case_id <> b.case_id")
def srch_duplicates(spark, sf_dir):
    """Documents whose text stands under another case too, by one aggregate on the hash."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL AND case_id IS NOT NULL").select("doc_id", "case_id", F.sha2("text", 256).alias("sha"))
    twice = d.groupBy("sha").agg(F.min("case_id").alias("a"), F.max("case_id").alias("z")).where("a <> z").select("sha")
    return d.join(twice, "sha", "left_semi").select("doc_id").distinct()


@query("srch_nearest", """
    WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0),
         s AS (SELECT query_id, vec_id, list_cosine_similarity(v::DOUBLE[], embedding::DOUBLE[]) AS score FROM q, embeddings),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
    SELECT query_id, vec_id, rank, round(score, 4) AS score FROM r WHERE rank <= 10""")
def srch_nearest(spark, sf_dir):
    """Ten nearest vectors of every query, against all vectors."""
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 100 = 0").select(c("vec_id").alias("query_id"), c("embedding").alias("query_vector"))
    return vectors.nearest(e, q, 10).select("query_id", "vec_id", c("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))


NEAREST = """q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0),
         p AS (SELECT vec_id, embedding, case_id, doc_type, coalesce(length(text), 0) >= 120 AS substantive, list_transform(regexp_extract_all(coalesce(text, ''), 'Section \\d+'), lambda x: x) AS statutes FROM embeddings JOIN documents ON doc_id = vec_id),
         s AS (SELECT query_id, p.*, list_cosine_similarity(v::DOUBLE[], p.embedding::DOUBLE[]) AS score FROM q, p)"""


def placed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the case, kind and provisions of the document they stand for."""
    d = table(spark, sf_dir, "documents").select(
        c("doc_id").alias("vec_id"), "case_id", "doc_type", (F.coalesce(F.length("text"), F.lit(0)) >= 120).alias("substantive"),
        F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"Section \d+"), F.lit(0)).alias("statutes"),
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding").join(d, "vec_id").withColumn("statutes_current", F.array().cast("array<string>"))


def asked_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select(c("vec_id").alias("query_id"), c("embedding").alias("query_vector"))


@query("srch_filtered", f"""
    WITH {NEAREST}, f AS (SELECT * FROM s WHERE substantive AND list_has_any(statutes, ['Section 4', 'Section 14', 'Section 24', 'Section 34', 'Section 44'])),
         r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM f)
    SELECT query_id, vec_id, rank, round(score, 4) AS score FROM r WHERE rank <= 5""")
def srch_filtered(spark, sf_dir):
    """Five nearest substantive documents of every query that cite one of some provisions."""
    points = vectors.filtered(placed_vectors(spark, sf_dir), statutes=[f"Section {n}" for n in (4, 14, 24, 34, 44)])
    return vectors.nearest(points, asked_vectors(spark, sf_dir), 5).select("query_id", "vec_id", c("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))


RANKED = f"""{NEAREST}, a AS (SELECT query_id, p.case_id AS want FROM q JOIN p ON vec_id = query_id WHERE p.case_id IS NOT NULL),
         r AS (SELECT s.*, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s WHERE substantive AND vec_id <> query_id),
         h AS (SELECT a.query_id, want, r.case_id, r.doc_type, r.rank FROM a LEFT JOIN r ON r.query_id = a.query_id AND rank <= 5),
         f AS (SELECT query_id, any_value(want) AS want, min(CASE WHEN case_id = want AND doc_type = 'judgment' THEN rank END) AS first, count(rank) AS got,
                      count(*) FILTER (WHERE case_id <> want) AS wrong, string_agg(coalesce(case_id, '?'), ',' ORDER BY rank) FILTER (WHERE rank <= 3) AS seen FROM h GROUP BY 1)"""


def searched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(hits, questions) of a search that asks with documents for others of their case."""
    placed = placed_vectors(spark, sf_dir)
    points = vectors.filtered(placed)
    found = vectors.nearest(points, asked_vectors(spark, sf_dir), 6).where("vec_id <> query_id")
    again = Window.partitionBy("query_id").orderBy("rank")
    hits = found.withColumn("rank", F.row_number().over(again)).where("rank <= 5").join(points.select("vec_id", "case_id", "doc_type"), "vec_id")
    hits = hits.select(c("query_id").alias("question"), "rank", "case_id", "doc_type", F.lit(None).cast("int").alias("paragraph_num"), F.lit(None).cast("int").alias("para_end"), F.lit(None).cast("int").alias("opinion_index"))
    asked = placed.where("vec_id % 100 = 0 AND case_id IS NOT NULL").select(c("vec_id").alias("question"), "case_id", F.array().cast("array<int>").alias("paragraphs"), F.lit(None).cast("int").alias("opinion_index"))
    return hits, asked


@query("eval_search", f"""WITH {RANKED} SELECT count(*) AS questions, round(count(first) / greatest(count(*), 1)::DOUBLE, 6) AS hit_at_k, round(coalesce(sum(1.0 / first), 0) / greatest(count(*), 1), 6)::DOUBLE AS mrr,
    round(coalesce(sum(wrong) / greatest(sum(got), 1)::DOUBLE, 0), 6)::DOUBLE AS drm_at_k FROM f""")
def eval_search(spark, sf_dir):
    """Measures of a real search: whether judgments of a document's case are among its five nearest."""
    return vectors.measures(*searched(spark, sf_dir), 5)


@query("eval_misses", f"WITH {RANKED} SELECT query_id AS question, want AS wanted, coalesce(seen, 'nothing') AS got FROM f WHERE first IS NULL")
def eval_misses(spark, sf_dir):
    """The questions that the search misses, with the cases it gives instead."""
    return vectors.misses(*searched(spark, sf_dir), 5)


@query("srch_keywords", f"SELECT chunk_id FROM {CHUNKS} WHERE list_has_all(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), ['appeal', 'section'])")
def srch_keywords(spark, sf_dir):
    return vectors.keyword_search(chunks(spark, sf_dir).select("chunk_id", "text"), "text", ["Appeal", "section"]).select("chunk_id")


@query("vec_hash", f"""
    WITH w AS (SELECT chunk_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM {CHUNKS}),
         b AS (SELECT chunk_id, ('0x' || md5(word)[1:8])::BIGINT % 256 AS place, count(*) AS n FROM w GROUP BY 1, 2)
    SELECT chunk_id, count(*) AS places, round(sqrt(sum(n * n)), 4) AS norm FROM b GROUP BY 1""")
def vec_hash(spark, sf_dir):
    v = vectors.hash_vectors(chunks(spark, sf_dir).where("length(text) > 0").select("chunk_id", "text"), "chunk_id", "text")
    return _vec_norms(chunks(spark, sf_dir), v)


def _vec_norms(chunks_: DataFrame, v: DataFrame) -> DataFrame:
    """Number of places and length before scaling, found back from the vector and the number of words."""
    words = chunks_.select("chunk_id", F.size(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("n")).where("n > 0")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    places = F.size(F.filter("vector", lambda x: x > 0)).cast("long")
    return v.join(words, "chunk_id").select("chunk_id", places.alias("places"), F.round(c("n") / total, 4).alias("norm"))


@query("smp_described", """
    WITH s AS (SELECT DISTINCT ON (file) * FROM judgment_sample WHERE file IS NOT NULL),
         x AS (SELECT 'era' AS measure, CASE WHEN decision_year BETWEEN 1950 AND 1989 THEN '1950-1989' WHEN decision_year BETWEEN 1990 AND 2009 THEN '1990-2009' WHEN decision_year BETWEEN 2010 AND 2025 THEN '2010-2025' END AS value FROM s
               UNION ALL SELECT 'length', CASE WHEN pages <= 8 THEN 'short' WHEN pages >= 40 THEN 'long' ELSE 'medium' END FROM s
               UNION ALL SELECT 'matter', CASE WHEN regexp_matches(coalesce(case_number, ''), '(?i)\\bCRIMINAL\\b|\\bCRL\\b') THEN 'criminal' ELSE 'civil / other' END FROM s
               UNION ALL SELECT 'bench', coalesce(bench_size || ' judges', 'bench unknown') FROM s)
    SELECT measure, value, count(*) AS n FROM x WHERE value IS NOT NULL GROUP BY 1, 2""")
def smp_described(spark, sf_dir):
    return sampling.described(one_per_key(table(spark, sf_dir, "judgment_sample"), "file").withColumn("year", c("decision_year")))


@query("smp_balanced", """
    WITH s AS (SELECT DISTINCT ON (file) *, CASE WHEN decision_year BETWEEN 1950 AND 1989 THEN '1950-1989' WHEN decision_year BETWEEN 1990 AND 2009 THEN '1990-2009' WHEN decision_year BETWEEN 2010 AND 2025 THEN '2010-2025' END AS era,
                      CASE WHEN pages <= 8 THEN 'short' WHEN pages >= 40 THEN 'long' ELSE 'medium' END AS length, coalesce(regexp_matches(case_number, '(?i)\\bCRIMINAL\\b|\\bCRL\\b'), false) AS crim, coalesce(bench_size >= 5, false) AS large
               FROM judgment_sample WHERE file IS NOT NULL),
         p AS (SELECT *, md5(path || '|20261007') AS h FROM s WHERE coalesce(bench, '') <> '' AND coalesce(decision_date, '') <> '' AND era IS NOT NULL),
         f AS (SELECT *, large AND row_number() OVER (PARTITION BY era, large ORDER BY h NULLS FIRST, path NULLS FIRST) <= 3 AS top FROM p),
         t AS (SELECT *, CASE WHEN top THEN '0' ELSE (CASE WHEN crim THEN '1-' ELSE '2-' END) || length END AS tier FROM f),
         k AS (SELECT *, top OR row_number() OVER (PARTITION BY era, tier ORDER BY h NULLS FIRST, path NULLS FIRST) <= round_even(20 * (CASE WHEN length = 'medium' THEN 0.5 ELSE 0.25 END) * (CASE WHEN crim THEN 0.4 ELSE 0.6 END), 0) AS within FROM t),
         n AS (SELECT *, row_number() OVER (PARTITION BY era ORDER BY CASE WHEN top THEN 0 WHEN within AND crim THEN 1 WHEN within THEN 2 ELSE 3 END, h NULLS FIRST, path NULLS FIRST) AS n FROM k)
    SELECT era, file, decision_year AS year FROM n WHERE n <= 20""")
def smp_balanced(spark, sf_dir):
    df = one_per_key(table(spark, sf_dir, "judgment_sample"), "file").withColumn("year", c("decision_year"))
    return sampling.balanced(df, 60).select("era", "file", "year")


WORDS = "list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z]{{4,}}'), lambda w: NOT list_contains([" + ", ".join(f"'{w}'" for w in sampling.COMMON) + "], w)))"
JUDGED = "(SELECT DISTINCT ON (file) file, title, try_cast(coalesce(regexp_replace(trim(decision_date), '^(\\d{2})-(\\d{2})-(\\d{4})$', '\\3-\\2-\\1'), '') AS DATE) AS day FROM judgment_sample WHERE file IS NOT NULL AND title IS NOT NULL)"


@query("smp_match", f"""
    WITH j AS (SELECT * FROM {JUDGED} WHERE day IS NOT NULL), w AS (SELECT file, day, {WORDS.format('title')} AS words FROM j),
         q AS (SELECT file AS question_id, day, string_split(title, ' versus ')[2] AS a, string_split(title, ' versus ')[1] AS b FROM j WHERE contains(title, ' versus ')),
         s AS (SELECT question_id, day, {WORDS.format('a')} AS a, {WORDS.format('b')} AS b FROM q),
         x AS (SELECT question_id, file AS path, len(list_intersect(list_distinct(list_concat(a, b)), words)) AS score FROM s JOIN w USING (day)
               WHERE (len(a) > 0 OR len(b) > 0) AND (len(a) = 0 OR list_has_any(a, words)) AND (len(b) = 0 OR list_has_any(b, words))),
         t AS (SELECT *, max(score) OVER (PARTITION BY question_id) AS most FROM x)
    SELECT question_id, min(path) AS path FROM t WHERE score = most AND score > 0 GROUP BY 1 HAVING count(*) = 1""")
def smp_match(spark, sf_dir):
    """Judgments found again from their parties in the other order, and their date written out."""
    s = one_per_key(table(spark, sf_dir, "judgment_sample"), "file").where("title IS NOT NULL")
    day = F.try_to_date(dates.iso_date(c("decision_date")))
    j = s.select(c("file").alias("path"), "title", day.alias("day")).where("day IS NOT NULL")
    parties = F.split("title", " versus ")
    swapped = F.concat(F.upper(F.get(parties, F.lit(1))), F.lit(" vs. "), parties[0])
    q = j.where(c("title").contains(" versus ")).select(c("path").alias("question_id"), swapped.alias("case_name"), F.date_format("day", "d'th' MMMM, yyyy").alias("date"))
    return sampling.match_questions(q, j)


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, code, section): the provisions that the documents' texts cite."""
    found = extract.statute_refs(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return found.select("doc_id", c("ref.code").alias("code"), c("ref.section").alias("section"))


#: The stored texts cite sections of named Acts only; the extractor's other forms are covered by its unit tests.
CITED = r"(?:Sections?|§)\s*\d{1,3}[A-Z]{0,2}(?:\s?\([0-9A-Za-z]{1,3}\))*\s+of\s+the\s+(?:[A-Z][A-Za-z]*\s+)+Act,?\s+\d{4}"
DOC_REFS = rf"""
    SELECT doc_id, regexp_replace(regexp_extract(m, 'of\s+the\s+(.*)$', 1, 's'), '\s+', ' ', 'g') AS code, regexp_replace(regexp_extract(m, '\d{{1,3}}[A-Z]{{0,2}}(?:\s?\([0-9A-Za-z]{{1,3}}\))*'), '\s', '', 'g') AS section
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{CITED}')) AS m FROM documents)"""
#: A table of correspondence made of the cited provisions: Levy Acts were followed by Relief Acts, section by section below 250.
FOLLOWED = r"code LIKE '% Levy Act, %' AND TRY_CAST(regexp_extract(section, '^\d+') AS INT) < 250"


def followed(cited: DataFrame) -> DataFrame:
    """(old_id, new_id) of the base sections that were followed."""
    base = ids.base_section(c("section"))
    old = cited.where(c("code").contains(" Levy Act, ") & (F.regexp_extract("section", r"^\d+", 0).try_cast("int") < 250)).select("code", base.alias("base")).distinct()
    return old.select(F.concat_ws(":", "code", "base").alias("old_id"), F.concat_ws(":", F.replace("code", F.lit(" Levy "), F.lit(" Relief ")), "base").alias("new_id"))


@query("ext_statutes", DOC_REFS)
def ext_statutes(spark, sf_dir):
    """The provisions cited in the documents, one row a mention."""
    return refs(spark, sf_dir)


@query("ext_cases")
def ext_cases(spark, sf_dir):
    """The cases cited in the passages, with their names; the extractor is held against a brute-force reading in the tests."""
    found = extract.case_refs(chunks(spark, sf_dir).select("chunk_id", "text"), "text")
    return found.select("chunk_id", F.array_join("ref.citations", "|").alias("citations"), c("ref.name_hint").alias("name"))


LOOKED_UP = rf"""
    r AS ({DOC_REFS}), m AS (SELECT DISTINCT code || ':' || regexp_replace(section, '\(.*$', '') AS old, replace(code, ' Levy ', ' Relief ') || ':' || regexp_replace(section, '\(.*$', '') AS new FROM r WHERE {FOLLOWED}),
    l AS (SELECT r.*, CASE WHEN e.old IS NOT NULL THEN 'exact' WHEN b.old IS NOT NULL THEN 'base' ELSE 'none' END AS match, coalesce(e.new, b.new) AS new
          FROM r LEFT JOIN m e ON e.old = r.code || ':' || r.section LEFT JOIN m b ON b.old = r.code || ':' || regexp_replace(r.section, '\(.*$', ''))"""


@query("jn_mapping", f"WITH {LOOKED_UP} SELECT DISTINCT code, section, match, coalesce(new, '') AS successors FROM l")
def jn_mapping(spark, sf_dir):
    """Each cited provision with its successor, by its exact section or its base section."""
    cited = checkpointed(refs(spark, sf_dir).select("code", "section").distinct())
    return mapping.lookup(cited, followed(cited)).select("code", "section", "match", F.array_join("successors", ",").alias("successors"))


@query("jn_passages_under_either", f"WITH {LOOKED_UP} SELECT coalesce(new, code || ':' || section) AS statute, count(DISTINCT doc_id) AS documents, count(DISTINCT doc_id) FILTER (WHERE new IS NOT NULL) AS under_old FROM l GROUP BY 1")
def jn_passages_under_either(spark, sf_dir):
    """The flagship: documents that cite a provision under its old or new number, counted by the new one."""
    cited = checkpointed(refs(spark, sf_dir))
    found = mapping.lookup(cited, followed(cited))
    statute = F.when(F.size("successors") > 0, c("successors")).otherwise(F.array(ids.statute_id(c("code"), c("section"))))
    each = found.select("doc_id", F.explode(statute).alias("statute"), (F.size("successors") > 0).alias("old"))
    return each.groupBy("statute").agg(F.count_distinct("doc_id").alias("documents"), F.count_distinct(F.when(c("old"), c("doc_id"))).alias("under_old"))


@query("val_mapping", "SELECT * FROM (VALUES ('warning', '2', 'rows are not verified'), ('warning', '4', 'rows are unreviewed')) v(level, provision, rule)")
def val_mapping(spark, sf_dir):
    return mapping.violations(examples(spark)).select("level", "provision", "rule")


@query("eval_measures", f"""
    WITH h AS (SELECT case_id, chunk_id, para_start, para_end, row_number() OVER (PARTITION BY case_id ORDER BY {ORDER}) AS rank FROM {CHUNKS} WHERE case_id IS NOT NULL),
         q AS (SELECT DISTINCT case_id FROM h),
         f AS (SELECT q.case_id, min(CASE WHEN 2 BETWEEN para_start AND para_end THEN rank END) AS first, count(rank) AS got FROM q LEFT JOIN h ON h.case_id = q.case_id AND rank <= 3 GROUP BY 1)
    SELECT count(*) AS questions, round(count(first) / greatest(count(*), 1)::DOUBLE, 6) AS hit_at_k, round(coalesce(sum(1.0 / first), 0) / greatest(count(*), 1), 6)::DOUBLE AS mrr, 0.0::DOUBLE AS drm_at_k FROM f""")
def eval_measures(spark, sf_dir):
    """Measures of a search that returns each case's passages in order, asked for paragraph 2."""
    from pyspark.sql.window import Window

    h = chunks(spark, sf_dir).where("case_id IS NOT NULL").withColumn("rank", F.row_number().over(Window.partitionBy("case_id").orderBy(*SEQ)))
    hits = h.select(c("case_id").alias("question"), "rank", "case_id", c("para_start").alias("paragraph_num"), "para_end", c("segment").alias("opinion_index"), F.lit("judgment").alias("doc_type"))
    asked = h.select(c("case_id").alias("question"), "case_id").distinct().withColumn("paragraphs", F.array(F.lit(2))).withColumn("opinion_index", F.lit(None).cast("int"))
    return vectors.measures(hits, asked, 3)


@query("top_statutes", f"SELECT code, section, count(*) AS mentions FROM ({DOC_REFS}) GROUP BY 1, 2 ORDER BY mentions DESC, code, section LIMIT 10")
def top_statutes(spark, sf_dir):
    """The ten provisions cited most: a report, so the limit is its feature."""
    return refs(spark, sf_dir).groupBy("code", "section").agg(F.count(F.lit(1)).alias("mentions")).orderBy(F.desc("mentions"), "code", "section").limit(10)


@query("flt_active", f"SELECT code, count(*) AS mentions FROM ({DOC_REFS}) WHERE code NOT IN ('IPC', 'CrPC') GROUP BY 1")
def flt_active(spark, sf_dir):
    """Mentions by the Acts that are in force: all but the replaced codes."""
    return refs(spark, sf_dir).where(~c("code").isin(*mapping.SUCCESSOR)).groupBy("code").agg(F.count(F.lit(1)).alias("mentions"))


@query("jn_blocks", f"WITH c AS (SELECT chunk_id, regexp_replace(chunk_id, '_\\d+$', '') AS block FROM {CHUNKS} c WHERE true), h AS (SELECT DISTINCT block FROM c JOIN {CHUNKS} d USING (chunk_id) WHERE contains(lower(d.text), 'overdraft')) SELECT chunk_id, block AS block_id FROM c JOIN h USING (block)")
def jn_blocks(spark, sf_dir):
    """All passages of the blocks in which a searched word stands."""
    rows = chunks(spark, sf_dir).select("chunk_id", ids.parent_id(c("chunk_id")).alias("block_id"), "text")
    hits = rows.where(F.lower("text").contains("overdraft"))
    return vectors.blocks_of(hits, rows.select("chunk_id", "block_id"))


@query("jn_author_bench")
def jn_author_bench(spark, sf_dir):
    """Members of the bench that the opinions' authors are, by surname and likeness."""
    from ..operators import records

    return records.authors_on_bench(one_per_key(table(spark, sf_dir, "opinions"), "opinion_id"), one_per_key(table(spark, sf_dir, "cases"), "case_id"))


@query("agg_modal", "SELECT court, doc_type, n FROM (SELECT court, doc_type, count(*) AS n, row_number() OVER (PARTITION BY court ORDER BY count(*) DESC, min(doc_id)) AS r FROM documents WHERE doc_type IS NOT NULL GROUP BY 1, 2) WHERE r = 1")
def agg_modal(spark, sf_dir):
    """The kind of document that each court has most of."""
    return quality.modal(table(spark, sf_dir, "documents"), "court", "doc_type", "doc_id")


PAIR_WORDS = "SELECT unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+')) AS word FROM "


@query("set_multiset", f"SELECT word, count(*) AS n FROM ({PAIR_WORDS} {PARAS} UNION ALL {PAIR_WORDS} {CHUNKS}) WHERE word <> '' GROUP BY 1")
def set_multiset(spark, sf_dir):
    """Words of paragraphs and passages, counts added up."""
    of = lambda df: df.select(F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return quality.multiset_union(of(paragraphs(spark, sf_dir)), of(chunks(spark, sf_dir)), "word")


@query("smp_limited", "SELECT file FROM (SELECT DISTINCT file FROM judgment_sample WHERE file IS NOT NULL) ORDER BY md5(file || '|20261007'), file LIMIT 25")
def smp_limited(spark, sf_dir):
    """Twenty-five judgments in seeded order."""
    return sampling.limited(one_per_key(table(spark, sf_dir, "judgment_sample"), "file"), "file", 25).select("file")


STATUS = "CASE WHEN len(missing) > 1 THEN 'reject' WHEN len(missing) = 1 OR len(conflicts) > 0 THEN 'review' ELSE 'ok' END"


@query("ing_gates", f"""
    WITH f AS (SELECT DISTINCT ON (case_id) case_id, coalesce(file, '') AS file, {STATUS} AS status, sha256(coalesce(summary, case_name)) AS sha FROM cases WHERE case_id IS NOT NULL),
         o AS (SELECT *, CASE WHEN sha IS NOT NULL AND status <> 'reject' THEN row_number() OVER (PARTITION BY sha, status = 'reject' ORDER BY case_id, file) END AS r FROM f)
    SELECT case_id, status, CASE WHEN status = 'reject' THEN 'rejected' WHEN r > 1 THEN 'the document of another case' END AS refused FROM o""")
def ing_gates(spark, sf_dir):
    """Which case records would be ingested, and why the others are refused."""
    n = lambda x: F.coalesce(F.size(x), F.lit(0))
    status = F.when(n("missing") > 1, "reject").when((n("missing") == 1) | (n("conflicts") > 0), "review").otherwise("ok")
    rows = one_per_key(table(spark, sf_dir, "cases"), "case_id").select("case_id", F.coalesce("file", F.lit("")).alias("file"), status.alias("status"), F.sha2(F.coalesce("summary", "case_name"), 256).alias("doc_sha256"))
    return quality.admitted(rows).select("case_id", "status", "refused")


@query("agg_verdicts", f"SELECT status, count(*) AS n FROM (SELECT DISTINCT ON (case_id) {STATUS} AS status FROM cases WHERE case_id IS NOT NULL) GROUP BY 1")
def agg_verdicts(spark, sf_dir):
    """Number of case records by status."""
    return ing_gates(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("snk_drafts", "SELECT DISTINCT ON (case_id) case_id, case_name, case_date::VARCHAR AS date, array_to_string(bench, '; ') AS bench, array_to_string(missing, ',') AS missing FROM cases WHERE source = 'auto' AND case_id IS NOT NULL")
def snk_drafts(spark, sf_dir):
    """Draft records of the cases that were read automatically, to be checked by hand."""
    rows = one_per_key(table(spark, sf_dir, "cases"), "case_id").where("source = 'auto'")
    return rows.select("case_id", "case_name", c("case_date").cast("string").alias("date"), F.array_join("bench", "; ").alias("bench"), F.array_join("missing", ",").alias("missing"))


@query("src_words", "SELECT page_id, i - 1 AS line_no, array_to_string(list_filter(string_split(x, ' '), lambda w: trim(w) <> ''), ' ') AS text FROM (SELECT page_id, unnest(list_filter(lines, lambda l: l IS NOT NULL AND trim(l) <> '')) AS x, generate_subscripts(list_filter(lines, lambda l: l IS NOT NULL AND trim(l) <> ''), 1) AS i FROM (SELECT DISTINCT ON (page_id) * FROM case_pages WHERE page_id IS NOT NULL))")
def src_words(spark, sf_dir):
    """Lines put together again from the words of the pages, as a recogniser gives them."""
    from ..operators import layout

    pages = one_per_key(table(spark, sf_dir, "case_pages"), "page_id").select("page_id", F.posexplode("lines").alias("line", "x"))
    words = pages.select("page_id", F.lit(0).alias("block"), F.lit(0).alias("par"), "line", F.posexplode(F.split("x", " ")).alias("left", "word"), (c("line") * 40).alias("top"))
    return layout.lines_of_words(words).select("page_id", c("line_no").cast("long").alias("line_no"), "text")


@query("gr_alerts", f"""
    WITH {LOOKED_UP}, p AS (SELECT DISTINCT code || ':' || regexp_replace(section, '\\(.*$', '') AS statute_id FROM r WHERE code LIKE '% Levy Act, %')
    SELECT p.statute_id, m.new AS new_id FROM p LEFT JOIN m ON m.old = p.statute_id""")
def gr_alerts(spark, sf_dir):
    """Cited provisions of the Acts that were followed, with their successors where they have one."""
    cited = checkpointed(refs(spark, sf_dir))
    provisions = cited.select("code", F.concat_ws(":", "code", ids.base_section(c("section"))).alias("statute_id")).distinct()
    return graph.alerts(provisions, followed(cited), ~c("code").contains(" Levy Act, ")).select("statute_id", "new_id")


@query("gr_edges_around", f"""
    WITH k AS (SELECT {KEY.format('x')} AS key, min(case_id) AS target FROM (SELECT case_id, unnest(citations) AS x FROM cases) GROUP BY 1),
         o AS (SELECT DISTINCT case_id, {KEY.format('x')} AS key FROM (SELECT case_id, unnest(overrules) AS x FROM cases)),
         e AS (SELECT DISTINCT o.case_id, coalesce(k.target, 'cite:' || o.key) AS target FROM o LEFT JOIN k USING (key) WHERE coalesce(k.target, 'cite:' || o.key) <> o.case_id),
         x AS (SELECT min(target) AS id FROM e)
    SELECT case_id, target FROM e, x WHERE case_id = id OR target = id""")
def gr_edges_around(spark, sf_dir):
    """The edges around one case: the least that any other overrules."""
    edges = checkpointed(gr_overrules(spark, sf_dir).select("case_id", "target"))
    least = edges.agg(F.min("target")).first()[0]
    return graph.edges_around(edges, least or "")
