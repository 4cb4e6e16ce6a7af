import datetime as dt

import pytest
from casewright.functions import dates
from casewright.functions import text as tx
from casewright.operators import layout, quality, records, reports, roles, sampling, segmentation, sequences, vectors
from casewright.operators.segmentation import Line
from pyspark.sql import functions as F


def each(spark, values, out, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", out(F.col("x")).alias("y")).orderBy("i").collect()]


def test_headings_and_names(spark):
    known = F.array(F.lit("submissions of the appellant"), F.lit("facts"))
    assert each(spark, ["FACTS :", "Submissions of the", "Submissions", "F A C T S", "", None, "Facts and more"], lambda x: tx.known_heading(x, known)) == [True, True, False, True, False, False, False]
    assert each(spark, ["(Khanna, J.)", "[R. F. NARIMAN, J.] 12", "MISRA, CJI (For himself and Khanwilkar, J.)", "no bracket", None], tx.header_judge) == ["Khanna", "R. F. NARIMAN", None, None, None]
    assert each(spark, ["40 SUPREME COURT REPORTS [1973] Supp. S.C.R.", "SUPREMB COURT REPOR'rS", "THE SUPREME COURT", "", None], tx.report_header) == [True, True, False, False, False]
    got = spark.createDataFrame([("REDoY", "Jaganmohan Reddy"), ("HEGDE AND MuKHERJEA", "Hegde & Mukherjea"), ("Khanna", "Ray"), (None, "Ray"), ("Ray", None)], "a string, b string").select(tx.names_match(F.col("a"), F.col("b")).alias("y")).collect()
    assert [r["y"] for r in got] == [True, True, False, False, False]


def test_dates_of_lines(spark):
    assert each(spark, ["May 9, i982", "in lO5 of l9O5", None, "word1982"], dates.repaired_year) == ["May 9, 1982", "in lO5 of 1905", None, "word1982"]
    assert each(spark, ["New Delhi; September 26, 2018.", "On September 26, 2018 the court sat", "5.8.2005", "", None], dates.date_line) == [dt.date(2018, 9, 26), None, dt.date(2005, 8, 5), None, None]
    want = dt.date(2001, 1, 9)
    assert each(spark, ["9th January 2001", "9 January, 2001", "January 9, 2001", "09-01-2001", "9.1.2001", "2001-01-09", "9/1/2001", "soon", None], dates.question_date) == [want] * 7 + [None, None]


def test_html_fields(spark):
    page = "<strong>Coram : A. SEN<sup class='tooltip-sup'>i</sup>, B. RAO*, </strong><br>The head <i>note</i>.<br><strong class='caseDetailsTD'><span>Case No :</span><font size=1> CIVIL  APPEAL 5</font><span>Bench :</span><font> 2 Judges"
    got = each(spark, [page, "", None, "<p>x</p>"], records.html_fields)
    assert (list(got[0]["bench"]), got[0]["author"], got[0]["case_number"], got[0]["bench_size"], got[0]["headnote"]) == (["A. SEN i", "B. RAO"], "A. SEN i", "CIVIL APPEAL 5", 2, "The head note .")
    assert all(list(g["bench"]) == [] and g["author"] is None and g["bench_size"] is None for g in got[1:])


def test_authors_on_bench(spark):
    cases = spark.createDataFrame([("c", ["D. G. Palekar", "H. R. Khanna", None]), ("d", None)], "case_id string, bench array<string>")
    ops = spark.createDataFrame([("o1", "c", "PALEKAR"), ("o2", "c", "Khana"), ("o3", "c", "Ray"), ("o4", "c", None), ("o5", "d", "Khanna"), ("o6", "none", "Khanna")], "opinion_id string, case_id string, author string")
    got = {r["opinion_id"]: r["member"] for r in records.authors_on_bench(ops, cases).collect()}
    assert got == {"o1": "D. G. Palekar", "o2": "H. R. Khanna", "o3": None, "o4": None, "o5": None, "o6": None}


def test_gates(spark):
    rows = [("a", "f1", "ok", "s1"), ("a", "f2", "ok", "s2"), ("b", "f3", "ok", "s1"), ("c", "f4", "reject", "s3"), ("d", "f5", "review", "s3"), ("e", "f6", "ok", None)]
    df = spark.createDataFrame(rows, "case_id string, file string, status string, doc_sha256 string")
    of = lambda **k: {r["file"]: r["refused"] for r in quality.admitted(df, **k).collect()}
    assert of() == {"f1": None, "f2": "another file of the case", "f3": "the document of another case", "f4": "rejected", "f5": None, "f6": None}
    assert of(only_ok=True)["f5"] == "for review" and of(force=True)["f3"] is None and of(force=True)["f4"] is None
    assert quality.admitted(df.where("false")).count() == 0


def test_counts(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "y", 2), ("g", "y", 3), ("g", "x", 4), ("g", None, 0), ("h", "z", 1)], "g string, v string, o int")
    assert {(r["g"], r["v"], r["n"]) for r in quality.modal(df, "g", "v", "o").collect()} == {("g", "x", 2), ("h", "z", 1)}
    a = spark.createDataFrame([("x", 2), ("y", 1)], "w string, n long")
    assert {(r["w"], r["n"]) for r in quality.multiset_union(a, a.where("w = 'x'"), "w").collect()} == {("x", 4), ("y", 1)}
    sizes = spark.createDataFrame([("c", x) for x in (5, 1, 9, 4)] + [("d", 7), ("d", None)], "g string, n int")
    assert {tuple(r) for r in quality.sizes(sizes, "g", "n").collect()} == {("c", 4, 1, 4, 5, 9), ("d", 1, 7, 7, 7, 7)}
    assert [r["w"] for r in sampling.limited(a, "w", 1).collect()] == [min(("x", "y"), key=lambda w: __import__("hashlib").md5(f"{w}|20261007".encode()).hexdigest())]
    q = spark.createDataFrame([(1, "why?"), (2, "when?")], "question_id int, query string")
    m, c = spark.createDataFrame([(1, "p")], "question_id int, path string"), spark.createDataFrame([("p", "case")], "path string, case_id string")
    assert [(r["query"], r["case_id"], r["paragraphs"]) for r in sampling.question_set(q, m, c).collect()] == [("why?", "case", [])]


def test_words_blocks_and_vectors(spark):
    w = spark.createDataFrame([("p", 0, 0, 1, 50, 100, "world"), ("p", 0, 0, 1, 10, 101, "Hello"), ("p", 0, 0, 0, 10, 20, "First"), ("p", 0, 0, 2, 5, 300, " ")], "page_id string, block int, par int, line int, left int, top int, word string")
    assert [(r["line_no"], r["text"]) for r in layout.lines_of_words(w).orderBy("line_no").collect()] == [(0, "First"), (1, "Hello world")]
    passages = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "chunk_id string, block_id string")
    assert sorted(r["chunk_id"] for r in vectors.blocks_of(passages.where("chunk_id = 'a'"), passages).collect()) == ["a", "b"]
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")
    assert vectors.checked_size(v, "v", 2).count() == 2
    with pytest.raises(ValueError, match=r"\[2\]"):
        vectors.checked_size(v, "v", 3)


def test_carried_numbering_and_titles():
    first = [Line(1, "A v. B"), Line(1, "JUDGMENT"), *[Line(1, f"{n}. Paragraph {n} ends.") for n in range(1, 6)]]
    second = [Line(2, "A v. B"), Line(2, "JUDGMENT"), *[Line(2, f"{n}. Paragraph {n} ends.") for n in range(6, 10)]]
    found, head = segmentation.segment(first + second)
    assert [(p["segment"], p["number"]) for p in found] == [(0, n) for n in range(1, 6)] + [(1, n) for n in range(6, 10)] and head == "A v. B A v. B"
    lines = [Line(1, "JUDGMENT"), Line(1, "1. HISTORICAL BACKGROUND"), Line(1, "1.1. One thing."), Line(1, "1.2. Another thing."), Line(1, "2. Second one."), Line(1, "3. Third one.")]
    found, _ = segmentation.segment(lines)
    assert [(p["label"], p["heading"]) for p in found[:3]] == [("1.1", "HISTORICAL BACKGROUND"), ("1.2", "HISTORICAL BACKGROUND"), ("2", None)]


def test_roles_and_packing_of_a_long_opinion(spark):
    # sides that turn again and again, held against a plain reading from left to right
    import random

    rng = random.Random(2)
    said = [rng.choice(["Learned counsel for the appellant submitted that it is bad.", "Per contra, it is good.", "He further submitted more.", "The facts of the case are short.", "Nothing much."]) for _ in range(300)]
    df = spark.createDataFrame([("c", 0, i, t, None, "A v. B") for i, t in enumerate(said)], "case_id string, segment int, para_seq int, text string, heading string, case_name string")
    got = [r["role"] for r in roles.label(df, F.lit(False), F.lit(False)).orderBy("para_seq").collect()]
    before, turn = None, {"argument_petitioner": "argument_respondent", "argument_respondent": "argument_petitioner"}
    for text, role in zip(said, got, strict=True):
        want = {"L": "argument_petitioner", "T": "facts", "N": "unlabelled"}.get(text[0])
        want = turn.get(before, "argument") if text[0] == "P" else (before if before and before.startswith("argument") else "argument") if text[0] == "H" else want
        assert role == want
        before = role
    paras = df.select("case_id", "segment", "para_seq", F.col("para_seq").alias("number"), F.lit(None).cast("string").alias("label"), F.lit(1).alias("page"), "text", F.lit("facts").alias("role"), "heading")
    packed = sequences.pack(paras).orderBy("chunk").collect()
    assert sum(len(r["labels"]) for r in packed) == 300 and all(len(r["text"]) <= 804 for r in packed) and [r["chunk"] for r in packed] == list(range(len(packed)))


def test_judge_runs(spark):
    named = ["Khanna", "Khanua", "Kxqzz", "Khanna", "Ray", "Ray", "Rav", "J", "Khanna", None]
    df = spark.createDataFrame([("c", i, n) for i, n in enumerate(named)] + [("d", 1, "Bose"), (None, 1, "X"), ("d", None, "Bose"), ("d", 1, "Bose")], "case_id string, page int, name string")
    got = sorted(tuple(r) for r in reports.judge_runs(df).collect())
    assert got == [("c", 0, "Khanna", 0, 3, 3), ("c", 1, "Ray", 4, 6, 3), ("c", 2, "Khanna", 8, 8, 1), ("d", 0, "Bose", 1, 1, 1)]
    assert reports.judge_runs(df.where("false")).count() == 0
    pages = spark.createDataFrame([("c", 1, ["REPORTS 1973", "A v. B (Khanna, J.) 12", "text"]), ("c", 2, None), ("c", 3, [None, "text"])], "case_id string, page int, lines array<string>")
    assert [tuple(r) for r in reports.header_names(pages).collect()] == [("c", 1, "Khanna")]
