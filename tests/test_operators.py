import datetime as dt

from pyspark.sql import functions as F

from casewright.operators import extract, graph, layout, mapping, quality, records, roles, sampling, segmentation, sequences, vectors
from casewright.operators.segmentation import Line
from casewright.plans import relational_q
from casewright.streaming import ingest


def test_statutes():
    ids = lambda t: [(c, s) for c, s, _, _ in extract.statutes(t)]
    for t in ("Section 304A IPC", "S. 304-A of the Indian Penal Code", "u/s 304A I.P.C.", "IPC 304A", "IPC Sec. 304A", "§ 304A of the Penal Code", "Section 3O4A IPC"):
        assert ids(t) == [("IPC", "304A")], t
    assert ids("Sections 302, 307 and 34 IPC") == [("IPC", "302"), ("IPC", "307"), ("IPC", "34")]
    assert ids("Section 497 IPC. Section 198 CrPC deals with it") == [("IPC", "497"), ("CrPC", "198")]
    assert ids("Article 17 of the ICCPR") == [] and ids("Articles 14 and 21") == [("Constitution", "14"), ("Constitution", "21")]
    assert ids("In Uganda, Section 154 of the Penal Code applies") == []
    assert ids("Section 304A.") == [] and ids(None) == [] and ids("") == []
    assert ids("Section 138 of the Negotiable Instruments Act, 1881") == [("Negotiable Instruments Act, 1881", "138")]


def test_cases():
    (written, name, _, keys), = extract.cases("See Jacob Mathew v. State of Punjab, (2005) 6 SCC 1 : AIR 2005 SC 3180.")
    assert written == ["(2005) 6 SCC 1", "AIR 2005 SC 3180"] and name == "Jacob Mathew v. State of Punjab" and keys[0] == "2005-6-scc-1"
    (first, second) = extract.cases("and the end. M/s. Ram Lal & Co. Ltd. v. Union of India reported in [1999] 3 SCR 22; see Hari Singh vs. State (2001) 1 SCC 5 = 2001 SCC (Cri) 77")
    assert first[:2] == (["(1999) 3 SCR 22"], "M/s. Ram Lal & Co. Ltd. v. Union of India") and second[:2] == (["(2001) 1 SCC 5", "2001 SCC (Cri) 77"], "Hari Singh v. State")
    assert [c[1] for c in extract.cases("It was held there. Gopal v. State, AIR 1950 SC 27, 2000 INSC 1; " + "x" * 200 + " v. State AIR 1951 SC 3")] == ["Gopal v. State", None]
    assert extract.cases("nothing here") == [] and extract.cases(None) == []
    assert [c[0] for c in extract.cases("2005 INSC 384 and [1990] 2 WLR 9")] == [["2005 INSC 384"], ["[1990] 2 WLR 9"]]


def test_cited_of_cases(spark):
    rows = spark.createDataFrame(
        [("c", 1, 1, ["(2005) 6 SCC 1"], None, 0, ["k1"]), ("c", 2, 2, ["(2005) 6 SCC 1", "AIR 2005 SC 3"], "A v. B", 4, ["k1", "k2"]), ("c", 3, 3, ["own"], "S", 0, ["me"])],
        "case_id string, para_seq int, number int, citations array<string>, name_hint string, start int, keys array<string>",
    )
    rows = rows.select("case_id", "para_seq", "number", F.struct("citations", "name_hint", "start", "keys").alias("ref"))
    got = extract.cited_of_cases(rows, F.array(F.lit("me"))).collect()
    assert len(got) == 1 and got[0]["keys"] == ["k1", "k2"] and got[0]["name_hint"] == "A v. B" and got[0]["paragraphs"] == [1, 2]


def test_mapping(spark):
    m = relational_q.examples(spark)
    refs = spark.createDataFrame([("IPC", "304A(2)", 1), ("IPC", "377", 2), ("IPC", "999", 3), ("IPC", "506", 4)], "code string, section string, successors_of int")
    got = {r["section"]: (r["match"], r["successors"]) for r in mapping.lookup(refs, m).collect()}
    assert got == {"304A(2)": ("base", ["BNS:106(1)"]), "377": ("exact", []), "999": ("none", []), "506": ("exact", ["BNS:351(2)", "BNS:351(3)"])}
    assert [r[0] for r in mapping.unmapped(refs, m).collect()] == ["IPC:999"]
    bad = spark.createDataFrame([("IPC", "1", "BNSS", "2", "same", "", None, "2024-07-01", "", "no"), ("X", "1", None, None, "odd", "", None, None, "s", "yes")], ", ".join(f"{c} string" for c in mapping.COLUMNS))
    rules = {r["rule"] for r in mapping.violations(mapping.normalized(bad)).collect()}
    assert {"the successor is of another code", "source is empty", "old_code is unknown", "relation is unknown", "a successor is required"} <= rules


def test_windows(spark):
    df = spark.createDataFrame([("c", 1, "a", None), ("c", 2, "a", None), ("c", 3, None, "h"), ("c", 4, None, "h"), ("c", 5, "a", None)], "case_id string, seq int, role string, heading string")
    got = sequences.blocks(df, "case_id", ["seq"], ["role", "heading"]).orderBy("seq").collect()
    assert [(r["block_id"], r["block_index"]) for r in got] == [("c_b0", 0), ("c_b0", 1), ("c_b1", 0), ("c_b1", 1), ("c_b2", 0)]
    gaps = sequences.number_gaps(spark.createDataFrame([("c", 1), ("c", 2), ("c", 5), ("c", 5), ("c", None), ("c", 20)], "g string, n int"), ["g"], "n").collect()
    assert gaps[0]["missing"] == 16 and gaps[0]["first"] == [3, 4, 6, 7, 8, 9]
    notes = spark.createDataFrame([("c", 1, 0, "early"), ("c", 4, 0, "late")], "case_id string, page int, note_seq int, note string")
    paras = spark.createDataFrame([("c", 2, 1, "p1"), ("c", 3, 2, "p2")], "case_id string, page int, para_seq int, para_id string")
    assert {r["note"]: r["para_id"] for r in sequences.notes_to_paragraphs(notes, paras).collect()} == {"early": None, "late": "p2"}


def brute_pack(ps, target=200, most=384, tiny=30):
    tok = lambda n: max(1, round(n / 4))
    groups, now = [], []
    for p in ps:
        size = tok(len(p["text"]))
        if now:
            role = next((q["role"] for q in now if q["role"] != "unlabelled"), "unlabelled")
            lead = all(q["role"] == "unlabelled" and tok(len(q["text"])) < tiny for q in now)
            fits = tok(len(" ".join(q["text"] for q in now))) + size <= target
            if not (fits and size <= most and (lead or (p["role"] == role and p["heading"] == now[-1]["heading"]))):
                groups.append(now)
                now = []
        if size > most:
            groups.append([p])
            continue
        now.append(p)
    return groups + ([now] if now else [])


def test_pack_against_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = []
    for seg in range(4):
        for i in range(40):
            rows.append(("c", seg, i, i + 1, str(i + 1), 1, "x" * rng.choice([0, 20, 90, 300, 500, 1600]), rng.choice(["facts", "facts", "unlabelled", "analysis"]), rng.choice([None, "H"])))
    names = "case_id segment para_seq number label page text role heading".split()
    df = spark.createDataFrame(rows, "case_id string, segment int, para_seq int, number int, label string, page int, text string, role string, heading string")
    got = sequences.pack(df.withColumn("chunk", F.lit("clash"))).orderBy("segment", "chunk").collect()
    for seg in range(4):
        want = brute_pack([dict(zip(names, r, strict=True)) for r in rows if r[1] == seg])
        mine = [r["labels"] for r in got if r["segment"] == seg]
        assert mine == [[p["label"] for p in g] for g in want]
    assert sequences.pack(df.where("false")).count() == 0


def test_long_paragraphs_are_cut(spark):
    tok = lambda t: max(1, round(len(t) / 4))
    said = [f"Sentence {chr(97 + i % 26)}x number {'w' * (i % 40)} stands in the case of A v. B here." for i in range(90)]
    endless = " ".join(f"word{i}," if i % 50 == 49 else f"word{i}" for i in range(900))
    table = "~".join(f"ledger|{i}|Town" for i in range(300))
    texts = {"1": " ".join(said), "2": "Short one.", "3": endless, "4": " " * 1700, "5": table, "6": "x" * 1600}
    rows = [("c", 0, i, int(n), n, 1, t, "facts", None) for i, (n, t) in enumerate(texts.items())]
    df = spark.createDataFrame(rows, "case_id string, segment int, para_seq int, number int, label string, page int, text string, role string, heading string")
    got = sequences.cut_long(sequences.pack(df)).orderBy("chunk", "chunk_part").collect()
    parts = {n: [(r["chunk_part"], r["text"]) for r in got if r["first"] == n] for n in texts}
    assert parts["2"] == [(None, "Short one.")] and parts["4"] == []
    for n in "1356":
        assert len(parts[n]) > 1 and [k for k, _ in parts[n]] == list(range(len(parts[n]))) and all(tok(t) <= 384 for _, t in parts[n])
    assert all("".join(t for _, t in parts[n]) == texts[n] for n in "56") and parts["5"][0][1][-1] in "~|"
    # two sentences are repeated, and without them the parts are the text
    first, whole = [t for _, t in parts["1"]], ""
    for k, t in enumerate(first):
        new = t
        if k:
            carried = " ".join(sequences._sentences(first[k - 1])[-2:])
            assert t.startswith(carried)
            new = t[len(carried) :]
        whole += new
    assert whole == texts["1"]
    assert set(endless.split()) == {w for _, t in parts["3"] for w in t.split()} and all(t.endswith((",", endless[-7:])) or tok(t) >= 345 for _, t in parts["3"])


def test_passages_carry_parts(spark):
    from casewright.plans import pipeline

    long = ["2. It is said that the matter went on for long."] + ["The court heard the parties at length and went on. It then rose for the day and the week."] * 30
    said = ["A v. B", "JUDGMENT", "1. First para of the case.", *long, "3. Third para of the case.", "4. Fourth para of the case."]
    lines = spark.createDataFrame([("k", 1, i, t, False, 72.0) for i, t in enumerate(said)], "doc_id string, page int, line int, text string, gap boolean, x0 double")
    cases = spark.createDataFrame([("k", "A v. B", "Supreme Court", dt.date(2000, 1, 1), ["c"], ["X"], "s")], "case_id string, case_name string, court string, case_date date, citations array<string>, bench array<string>, summary string")
    pages = lines.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("line", "text", "gap", "x0"))).alias("lines"))
    got = pipeline.passages(pages, cases, relational_q.examples(spark)).collect()
    names = [r["chunk_id"] for r in got]
    cut = sorted((r["chunk_part"], r["chunk_id"], r["parent_id"]) for r in got if r["chunk_part"] is not None)
    assert len(set(names)) == len(names) and len(cut) > 1 and max(r["tokens"] for r in got) <= 384
    assert cut == [(k, f"k_o0_p2_{k}", "k_o0_p2") for k in range(len(cut))]
    after = {r["chunk_id"]: r["next_chunk_id"] for r in got}
    assert after["k_o0_p2_0"] == "k_o0_p2_1" and after[cut[-1][1]] == next(n for n in names if n.startswith("k_o0_p3"))


def test_roles(spark):
    said = ["Learned counsel for the appellant submitted that it is bad.", "Per contra, it is good.", "He further submitted more.", "The facts of the case are short.", None, "We are of the view that this fails. “The appeal is dismissed.”", "The appeal is dismissed."]
    df = spark.createDataFrame([("c", 0, i, t, None, "A v. State of B") for i, t in enumerate(said)], "case_id string, segment int, para_seq int, text string, heading string, case_name string")
    got = [r["role"] for r in roles.label(df, F.lit(False), F.lit(False)).orderBy("para_seq").collect()]
    assert got == ["argument_petitioner", "argument_respondent", "argument_respondent", "facts", "unlabelled", "analysis", "ruling"]


def test_numbering():
    chain = segmentation.chain
    number = lambda ns: [n for _, n, _ in chain(list(enumerate(ns)))]
    assert number([1, 2, 3, 7, 4, 5]) == [1, 2, 3, 4, 5]
    assert number([1, 2, 4, 5, 6]) == [1, 2, 4, 5, 6]
    assert number([2, 3, 4]) == [2, 3, 4]
    assert [(n, r) for _, n, r in chain(list(enumerate([1, 2, 3, 4, 5, 1, 2, 3, 4, 5])))][5] == (1, 1)
    lines = [Line(1, "A v. B"), Line(1, "JUDGMENT"), Line(1, "KHANNA, J."), Line(1, "1. First para"), Line(1, "goes on."), Line(1, "FACTS"), Line(1, "2. Second."), Line(2, "3. Third."), Line(2, "New Delhi;")]
    found, head = segmentation.segment(lines)
    assert [(p["number"], p["text"], p["heading"]) for p in found] == [(1, "First para goes on.", None), (2, "Second.", "FACTS"), (3, "Third.", "FACTS")]
    assert head == "A v. B" and found[0]["author"] == "KHANNA" and segmentation.segment([]) == ([], "")
    plain, _ = segmentation.segment([Line(1, "One sentence that ends.") for _ in range(200)])
    assert len(plain) > 1 and plain[0]["numbering"] == "synthetic"


def test_no_word_of_an_opinion_is_lost(spark):
    import re
    from collections import Counter

    said = """A v. B
    JUDGMENT
    We have read the record with care.
    1. First para.
    2. Second para
    2.1. one limb of it
    2.2. another limb.
    FACTS
    THE APPEAL
    3. Third para.
    4. Fourth para ends here.
    5. Fifth para ends here.
    6. Sixth para ends here.
    7. Seventh para ends here.
    KHANNA, J. (dissenting)
    I regret that I cannot agree
    with my learned brother.
    REASONS
    1. Own first.
    2. Own second.
    3. Own third.
    POSTSCRIPT""".split("\n")
    lines = [Line(1, x) for x in said]
    found, head = segmentation.segment(lines)
    got = {(p["segment"], p["label"]): p for p in found}
    assert got[1, "0"]["text"] == "I regret that I cannot agree with my learned brother." and got[1, "0"]["numbering"] == "synthetic"
    assert got[1, "1"]["heading"] == "REASONS" and got[0, "0"]["text"] == "We have read the record with care." and head == "A v. B"
    assert got[0, "2.1"]["text"].endswith("one limb of it") and got[0, "2.2"]["number"] == 2 and got[0, "3"]["heading"] == "FACTS — THE APPEAL"
    words = lambda t: Counter(re.findall(r"[A-Za-z]+", t))
    heads = {p["heading"] for p in found if p["heading"]} | {p["author"] for p in found if p["author"]}
    kept = words(" ".join([head, *heads, *(p["text"] for p in found)]))
    assert words(" ".join(said)) - kept == words("JUDGMENT J dissenting")
    df = spark.createDataFrame([("d", i, 1, x, None, None) for i, x in enumerate(said)], "doc_id string, line_no int, page int, text string, x0 double, gap boolean")
    assert [tuple(r) for r in segmentation.headers(df).collect()] == [("d", "A v. B")] and segmentation.paragraphs(df).count() == len(found)


def test_segmentation_frame(spark):
    rows = [("d", i, 1, t, None, None) for i, t in enumerate(["JUDGMENT", "1. A.", None, "2. B.", "3. C."])]
    df = spark.createDataFrame(rows, "doc_id string, line_no int, page int, text string, x0 double, gap boolean")
    assert [r["text"] for r in segmentation.paragraphs(df).orderBy("para_seq").collect()] == ["A.", "B.", "C."]
    assert segmentation.paragraphs(df.where("false")).count() == 0


def test_layout(spark):
    words = [("d", 1, w, 10.0 * i, 10.0 * i + 8, 100.0, 12.0) for i, w in enumerate(["one", "two"])] + [("d", 1, "thr", 0.0, 5.0, 120.0, 12.0), ("d", 1, "ee", 5.4, 9.0, 121.0, 12.0), ("d", 1, "note", 50.0, 52.0, 119.0, 4.0)]
    df = spark.createDataFrame(words, "doc_id string, page int, text string, x0 double, x1 double, top double, size double")
    assert [r["text"] for r in layout.lines_of(df).orderBy("line").collect()] == ["one two", "three"]
    rows = []
    for p in range(1, 6):
        rows += [("d", p, 0, "SUPREME COURT REPORTS [2005]", False), ("d", p, 1, "text " + "ab" * p + " of body", True), ("d", p, 2, "more body words here", False), ("d", p, 3, "body " + "xy" * p, False), ("d", p, 4, f"{p}", False)]
    lines = spark.createDataFrame(rows, "doc_id string, page int, line int, text string, gap boolean")
    kept = layout.without_furniture(lines).collect()
    assert len(kept) == 15 and not any(r["gap"] for r in kept) and {r["line"] for r in kept} <= {1, 2, 3}


def test_graph(spark):
    cases = spark.createDataFrame([("a", ["k1"]), ("b", ["k2", "k3"])], "case_id string, keys array<string>")
    citing = spark.createDataFrame([("a", ["k9", "k3"], [4]), ("a", ["k2"], [1, 4]), ("a", ["k1"], [2]), ("a", ["k7"], [5]), ("a", [], [1])], "case_id string, keys array<string>, paragraphs array<int>")
    got = {r["target"]: (r["stub"], r["paragraphs"]) for r in graph.resolve(citing, cases).collect()}
    assert got == {"b": (False, [1, 4]), "cite:k7": (True, [5])}
    later = spark.createDataFrame([("z", ["k7"])], "case_id string, keys array<string>")
    assert {r["target"] for r in graph.absorb(graph.resolve(citing, cases), later).collect()} == {"b", "z"}
    new = spark.createDataFrame([("x", 2, "n")], "id string, v int, t string")
    old = spark.createDataFrame([("x", 2, "o"), ("y", None, "o")], "id string, v int, t string")
    assert {(r["id"], r["t"]) for r in graph.upsert(old, new, "id", "v").collect()} == {("x", "n"), ("y", "o")}


def test_search_and_measures(spark):
    points = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [1.0, 0.0])], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, query_vector array<double>")
    assert [r["vec_id"] for r in vectors.nearest(points, q, 3).orderBy("rank").collect()] == [1, 5, 2]
    assert vectors.nearest(points, q.where("false"), 3).count() == 0
    named = spark.createDataFrame([(f"q{i}", [1.0, float(i)]) for i in range(40)] + [("none", None), ("short", [1.0])], "query_id string, query_vector array<double>")
    one = {(r["query_id"], r["vec_id"], r["rank"]) for r in vectors.nearest(points, named, 2).collect() if r["query_id"] != "short"}
    many = {(r["query_id"], r["vec_id"], r["rank"]) for r in vectors.nearest(points, named.where("query_id <> 'short'"), 2, held=64).collect()}
    assert one <= many and len(many) == 80
    full = spark.createDataFrame([(1, True, "a", ["IPC:302"], []), (2, None, "a", None, ["IPC:302"]), (3, False, "a", ["IPC:302"], []), (4, True, "b", ["IPC:1"], None)], "vec_id int, substantive boolean, case_id string, statutes array<string>, statutes_current array<string>")
    of = lambda **k: sorted(r["vec_id"] for r in vectors.filtered(full, **k).collect())
    assert of() == [1, 2, 4] and of(statutes=["IPC:302"]) == [1, 2] and of(case_id="b") == [4] and of(substantive_only=False, statutes=["IPC:302"]) == [1, 2, 3]
    hits = spark.createDataFrame([(1, r, c, p, p, 0, "judgment") for r, c, p in [(1, "x", 1), (2, "a", 4)]] + [(2, r, "x", 1, 1, 0, "judgment") for r in (1, 2)], "question int, rank int, case_id string, paragraph_num int, para_end int, opinion_index int, doc_type string")
    asked = spark.createDataFrame([(1, "a", [4], None), (2, "a", [4], None)], "question int, case_id string, paragraphs array<int>, opinion_index int")
    m = vectors.measures(hits, asked, 3).first()
    assert (m["hit_at_k"], m["mrr"], m["drm_at_k"]) == (0.5, 0.25, 0.75)
    assert [tuple(r) for r in vectors.misses(hits, asked, 3).collect()] == [(2, "a", "x,x")]
    assert [r["got"] for r in vectors.misses(hits.where("false"), asked, 3).collect()] == ["nothing"] * 2 and vectors.measures(hits, asked.where("false"), 3).first()["questions"] == 0
    v = vectors.hash_vectors(spark.createDataFrame([(1, "a a b"), (2, ""), (3, None)], "id int, t string"), "id", "t").collect()
    assert {r["id"]: round(sum(x * x for x in r["vector"]), 6) for r in v} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_records(spark):
    head = ["IN THE SUPREME COURT", "RAM LAL & ORS. ...APPELLANTS", "Versus", "STATE OF PUNJAB ...RESPONDENT", "August 5, 2005", "[R.C. LAHOTI, G.P. MATHUR, JJ.]"]
    t = spark.createDataFrame([(head,)], "h array<string>").select(records.title_block(F.col("h")).alias("t")).first()["t"]
    assert (t["petitioner"], t["respondent"], t["date"]) == ("Ram Lal", "State of Punjab", dt.date(2005, 8, 5)) and len(t["bench"]) == 2
    o = spark.createDataFrame([("a", 0, "unknown", [], 3), ("b", 0, "unknown", ["x"], 3), ("b", 1, "dissenting", [], 3)], "case_id string, opinion_index int, kind string, joined array<string>, bench_size int")
    assert {(r["case_id"], r["opinion_index"]): r["kind"] for r in records.infer_majority(o).collect()} == {("a", 0): "majority", ("b", 0): "majority", ("b", 1): "dissenting"}
    c = spark.createDataFrame([("c", "Ram v. B", dt.date(2005, 8, 5), ["R. Sen"])], "case_id string, name string, date date, bench array<string>")
    text = spark.createDataFrame([("c", "Ram came on 5 August 2005.")], "case_id string, text string")
    assert [r["warning"] for r in records.checked(c, text).collect()] == ["not in the text: R. Sen"]


def test_sampling(spark):
    rows = [(f"p{i}", 1950 + i % 76, "x; y", "2001-01-01", 5 if i % 20 == 0 else 2, "CRIMINAL APPEAL" if i % 3 == 0 else "CIVIL", i % 60) for i in range(600)] + [("none", 1999, None, "2001-01-01", 2, None, 3)]
    df = spark.createDataFrame(rows, "path string, year int, bench string, decision_date string, bench_size int, case_number string, pages int")
    got = sampling.balanced(df, 60).collect()
    eras = {}
    for r in got:
        eras[r["era"]] = eras.get(r["era"], 0) + 1
    assert eras == {"1950-1989": 20, "1990-2009": 20, "2010-2025": 20} and len({r["path"] for r in got}) == 60
    day = dt.date(2001, 1, 9)
    j = spark.createDataFrame([("p1", "Ramesh Kumar versus State of Kerala", day), ("p2", "Ramesh Kumar versus Ashalata Devi", day), ("p3", "Dilawar versus State of Haryana", day), ("p4", "Nilima Bose versus Union of India", dt.date(2002, 2, 2)), ("p5", None, day), ("p6", "Ravi Prakash versus Mohan", None)], "path string, title string, day date")
    asked = [(1, "RAMESH KUMAR & ORS vs. ASHALATA DEVI", "9th January 2001"), (2, "Ashalata Devi v. Ramesh Kumar", "January 9, 2001"), (3, "Satpal vs. State of Haryana", "09-01-2001"), (4, "State v. Dilawar", "09.01.2001"),
             (5, "Nilima Bose versus Union of India", "2 February, 2002"), (6, "Nilima Bose versus Union of India", "2001-01-09"), (7, None, "2001-01-09"), (8, "Ramesh v. Kumar", "9/1/2001"), (9, "Nilima", "some day")]
    q = spark.createDataFrame(asked, "question_id int, case_name string, date string")
    assert {(r[0], r[1]) for r in sampling.match_questions(q, j).collect()} == {(1, "p2"), (2, "p2"), (4, "p3"), (5, "p4")}
    assert sampling.match_questions(q.where("false"), j).count() == 0


def test_quality(spark):
    a = quality.word_counts(spark.createDataFrame([("c", "one two two"), ("c", None)], "g string, t string"), "g", "t")
    b = quality.word_counts(spark.createDataFrame([("c", "Two one")], "g string, t string"), "g", "t")
    r = quality.words_lost(a, b, "g").first()
    assert (r["total"], r["lost"]) == (3, 1)


def test_text_outside_paragraphs(spark):
    lines = spark.createDataFrame(
        [("a", 1, 0, "1. one two be-"), ("a", 1, 1, "fore FACTS"), ("a", 2, 0, "lost lost gone"), ("b", 1, 0, "1. all here"), ("c", 1, 0, "nothing kept"), (None, 1, 0, "x")], "doc_id string, page int, line int, text string"
    )
    paras = spark.createDataFrame([("a", 1, "one two before", "FACTS"), ("a", 2, "lost", "FACTS"), ("b", 1, "all here", None), ("b", 2, None, None)], "case_id string, number int, text string, heading string")
    pages = lines.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]).alias("texts"))
    got = {r["case_id"]: round(r["outside"], 6) for r in quality.outside_share(pages, paras).collect() if r["case_id"]}
    assert got == {"a": 0.25, "b": 0.0, "c": 1.0}


def test_garbled_words_of_all_pages(spark):
    rows = [("a", i, "plain words here" if i != 2 else "plAin woRds stand") for i in range(1, 181)] + [("a", None, "woRds")]
    pages = spark.createDataFrame(rows, "g string, page int, t string")
    r = quality.garbled_share(pages, "g", "page", "t").first()
    assert (r["words"], r["garbled"]) == (541, round(3 / 541, 6))
    assert quality.garbled_share(pages, "g", "page", "t", 60).first()["garbled"] == 0.0


def test_ingest(spark, tmp_path):
    schema = "chunk_id string, case_id string, text string, loaded_at int"
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate([[("a1", "a", "old", 1), ("a2", "a", "gone", 1), ("b1", "b", "keep", 1)], [("a1", "a", "new", 2)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        if n == 0:
            spark.sparkContext.setCheckpointDir(str(tmp_path / "ck"))
        ingest.ingest(spark, src, dst, str(tmp_path / "state"), schema, buckets=4).awaitTermination()
    got = {(r["chunk_id"], r["text"]) for r in spark.read.parquet(dst).collect()}
    assert got == {("a1", "new"), ("b1", "keep")}
