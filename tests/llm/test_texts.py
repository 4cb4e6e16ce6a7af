from pyspark.sql import functions as F

from casewright.llm import encoding, languages, lookalikes, scans


def test_garble_and_invert():
    for text in ("the “order” — isn’t § 12", "São Luís", "अदालत ने"):
        for chain in encoding.CHAINS:
            g = encoding.garble(text, chain)
            if g and (chain != encoding.OCTAL or text.startswith("the")):  # cp1252 has not all letters
                assert encoding.invert(g, chain) == text, (chain, g)
    assert encoding.invert("plain", "utf8>cp1252") is None
    assert encoding.invert("the dowryâ€. So", "utf8>cp1252") == "the dowry”. So"
    assert encoding.garble("abc", "utf8>mac") is None
    for spelled in (r"the dowry\222s", r"the dowry\022s", r"the dowry\22s"):
        assert encoding.invert(spelled, encoding.OCTAL) == "the dowry’s"
    assert encoding.invert(r"he \05 said \0231957 and\or \9", encoding.OCTAL) == "he … said “1957 and\\or \\9"


def test_held_out_accuracy():
    words = [f"case{i}’s “w{i}” — § {i} ₹{i} Zoë{i}" for i in range(60)]
    model = encoding.fit(words[:40])
    right = total = 0
    for t in words[40:]:
        for chain in ("utf8>cp1252", "utf8>mac", "utf8>cp437", "cp1252>latin1", "utf8>cp1252 twice"):
            for w in encoding.words(encoding.garble(t, chain) or ""):
                scores = model.scores([w])[0]
                total += 1
                right += scores[0] < max(scores[1:])
    assert right / total > 0.95
    clean = [w for t in words[40:] for w in encoding.words(t)]
    assert (model.scores(clean).argmax(axis=1) == 0).mean() > 0.95


def test_find_garbled_frame(spark):
    lines = ["it isâ€™s here", "the “right” one", None, "", "lost ��� here", "Château Âvrel", "plain", r"the court\22s \223order\24", r"and\or C:\9 \x"]
    df = spark.createDataFrame([("p", lines, None, 1), ("p", lines, None, 2), ("q", None, ["noteâ€”x"], 1)], "page_id string, lines array<string>, footnotes array<string>, pos int")
    got = {(r["page_id"], r["field"], r["pos"], r["restored"]) for r in encoding.find_garbled(df).collect()}
    assert got == {("p", "lines", 0, "it is’s here"), ("p", "lines", 4, None), ("p", "lines", 7, "the court’s “order”"), ("q", "footnotes", 0, "note—x")}
    assert encoding.find_garbled(df.where("false")).count() == 0


def test_lookalikes(spark):
    e = [
        ("t", "a", 0, "the ｃｌｅａｒ оrder"), ("t", "b", 0, "aﬃdavit tha​t"), ("t", "c", 0, "“Велмораст” न्याय‍पत्र"), ("t", "d", 0, "wide space"),
        ("t", "e", 0, "café Zoë"), ("t", "f", 0, None), ("t", "g", 0, ""), ("t", "h", 0, "self‑help"), ("t", "a", 0, "the ｃｌｅａｒ оrder"), ("t", "i", 0, "海運　商会"),
    ]
    df = spark.createDataFrame(e, "record_table string, record_id string, pos int, text string")
    words = spark.createDataFrame([("the clear order of affidavit that café",), (None,)], "text string")
    got = {r["record_id"]: r["canonical"] for r in lookalikes.canonical_texts(df, words).collect()}
    assert got == {"a": "the clear order", "b": "affidavit that", "d": "wide space", "e": "café Zoë", "h": "self-help"}
    assert lookalikes.canonical_texts(df.where("false"), words).count() == 0
    other = [("t", "k", 0, "the 𝐜𝐥𝐞𝐚𝐫 ℴrder"), ("t", "l", 0, "the clear օrder"), ("t", "m", 0, "the Ꮯlear order"), ("t", "n", 0, "chapter Ⅳ"), ("t", "o", 0, "brand™ № 5 ᏣᎳᎩ հայ")]
    df = spark.createDataFrame(other, "record_table string, record_id string, pos int, text string")
    got = {r["record_id"]: r["canonical"] for r in lookalikes.canonical_texts(df, words).collect()}
    assert got == {"k": "the clear order", "l": "the clear order", "m": "the Clear order", "n": "chapter IV"}
    trie = lookalikes.Trie([("resume", 9), ("resumé", 1)])
    assert trie.best("resumé") == "resumé" and trie.best("rеsume") == "resume" and trie.best("other") is None


def test_scan_parts():
    assert set(scans.skeletons("remand")) & set(scans.skeletons("remancl"))
    assert set(scans.skeletons("inspected")) & set(scans.skeletons("iiispected"))
    assert not set(scans.skeletons("remand")) & set(scans.skeletons("tenant"))
    assert scans.bare("“!ncrement,") == "!ncrement" and scans.bare("order!") == "order"
    for x in ("Page 3 of 9", "- 2 -", "[ 4 ]", "3 / 4", "Pg. 7"):
        assert scans.STRONG.match(x), x
    assert scans.ROMAN.match("xlii") and not scans.ROMAN.match("court") and scans.BARE.match("3l") and not scans.BARE.match("5.")


def test_scan_frame(spark):
    body = ["the tenant of the company filed a reply", "and the court rejected the claim of the", "tenant, who had broken the lease be-", "fore the day. The self-defence plea of the", "tenant was not accepted by the court at"]
    rows = []
    for p in range(1, 41):
        lines = ["REGISTER OF CASES [2004] 3 R.A.D." if p % 2 else f"ABLE v. BAKER (Rao, J.) {p}", *body, f"- {p} -"]
        if p == 7:
            lines[2] = "and the courl rejected the c1aim of the"
        if p == 9:
            lines[-2] = "tenant was not accepted by the self-"
        if p == 10:
            lines[1] = "defence plea of the company before"
        rows.append(("case_pages", f"pg{p}", "c", p, lines))
    rows += [rows[0], ("case_pages", "none", "d", 1, [None, ""]), ("case_pages", "zero", "e", 1, [])]
    df = spark.createDataFrame(rows, "record_table string, record_id string, case_id string, page int, lines array<string>")
    df = df.withColumn("x0", F.lit(None).cast("array<double>")).withColumn("gap", F.lit(None).cast("array<boolean>"))
    found, _, _ = scans.findings(df)
    got = {(r["record_id"], r["pos"], r["kind"]) for r in found.collect()}
    assert {(f"pg{p}", 0, "running_header") for p in range(1, 41)} <= got and {(f"pg{p}", 6, "page_number") for p in range(1, 41)} <= got
    assert {(f"pg{p}", 3, "hyphen") for p in range(1, 41)} <= got and ("pg9", 5, "hyphen") not in got
    assert ("pg7", 2, "misread") in got and sum(k == "misread" for *_, k in got) == 1
    assert scans.findings(df.where("false"))[0].count() == 0
    text = " ".join(r["text"] for r in scans.paragraphs(df).orderBy("nth").collect())
    assert "broken the lease before the day" in text and "the court rejected the claim of the tenant" in text and "courl" not in text
    assert "accepted by the self-defence plea of the company" in text and "REGISTER" not in text and "- 7 -" not in text


def test_page_tops_are_counted_over_all_pages(spark):
    # a title of six pages among hundreds: a sample of 20 pages would not hold it five times
    body = [f"the tenant of the company filed reply {w} there" for w in "one two three four five six seven".split()]
    rows = [("case_pages", f"pg{i}", f"c{i % 50}", i, [f"{w} of the lease by its own terms", *body]) for i, w in enumerate(f"word{k % 90}" for k in range(400))]
    rows += [("case_pages", f"t{i}", "t", i, ["Quarvale textiles versus brenkot", *body]) for i in range(6)]
    rows += [("case_pages", f"u{i}", "u", i, ["Said in passing here", *body]) for i in range(6)] + [("case_pages", "u9", "u", 9, [*body[:4], "Said in passing here", *body[4:]])]
    df = spark.createDataFrame(rows, "record_table string, record_id string, case_id string, page int, lines array<string>")
    df = df.withColumn("x0", F.lit(None).cast("array<double>")).withColumn("gap", F.lit(None).cast("array<boolean>"))
    top, size = scans.tops(df)
    key, other = scans.opening("Quarvale textiles versus"), scans.opening("Said in passing")
    assert top[key] == 6 and top[other] == 6 and size == 2 * len(rows)
    middle, inner = scans.middles(df, frozenset(top))
    assert middle[other] == 1 and key not in middle and inner == 2 * sum(len(r[4][3:-2]) for r in rows)
    odds = scans.odds_of(top, middle, size, inner)
    assert odds[key] > 1.5 and other not in odds
    assert all(scans.told(k, n) for k, n in top.items())
    shapes = {}
    for r in rows:
        for x in r[4][3:-2]:
            shapes[scans.shape(x)] = shapes.get(scans.shape(x), 0) + 1
    assert all(middle.get(k, 0) == shapes.get(k, 0) for k in top if not k.startswith(">"))
    model = scans.train(df, odds, 20)
    assert model.odds is odds


def test_paragraphs_begin_at_break_labels(spark):
    # indents mark paragraphs on some pages, gaps on others; the model, not a rule, decides
    rows = []
    for p in range(60):
        lines, x0, gap = [], [], []
        for k in range(4):
            for j, text in enumerate((f"The tenant of house {p} paid rent number {k} to the", "owner of the land, who gave him the receipt of", "the last month.")):
                lines.append(text)
                x0.append(90.0 if j == 0 and p % 2 else 72.0)
                gap.append(j == 0 and not p % 2)
        rows.append(("case_pages", f"pg{p}", f"c{p}", 1, lines, x0, gap))
    df = spark.createDataFrame(rows, "record_table string, record_id string, case_id string, page int, lines array<string>, x0 array<double>, gap array<boolean>")
    texts = [r["text"] for r in scans.paragraphs(df).collect()]
    assert len(texts) == 240 and all(t.startswith("The tenant") and t.endswith("month.") for t in texts)
    pages = [scans.page_of(r[0], r[4], r[5], r[6]) for r in rows]
    model = scans.fit(pages, {})
    states, table_, starts, sizes = model.labels(scans.Reader({}), pages)
    assert len(states) == 720 and (states.reshape(-1, 3)[:, 0] == scans.BREAK).mean() > 0.7 and (states.reshape(-1, 3)[:, 1:] == scans.BODY).all()
    model.emit[-1][:] = 0  # without what it has learnt of the layout the paragraphs are others
    assert ((model.labels(scans.Reader({}), pages)[0] == scans.BREAK) != (states == scans.BREAK)).any()


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    model = scans.Model(rng.normal(size=4), rng.normal(size=(4, 4)), [rng.normal(size=(4, k)) for k in scans.SIZES], {})
    sizes = np.array([0, 3, 5, 1])
    table_ = np.stack([rng.integers(0, k, 9) for k in scans.SIZES], axis=1)
    starts = np.cumsum(sizes) - sizes
    got, e = model.path(table_, starts, sizes), model.scores(table_)
    for a, n in zip(starts, sizes, strict=True):
        if n:
            cost = lambda p: model.start[p[0]] + sum(e[a + i, s] for i, s in enumerate(p)) + sum(model.step[x, y] for x, y in itertools.pairwise(p))  # noqa: B023, E731
            assert tuple(got[a : a + n]) == max(itertools.product(range(4), repeat=int(n)), key=cost)


def test_languages(spark):
    english = "The court rejected the claim of the tenant. The judge heard the counsel for the company at length. "
    french = "Le tribunal a rejeté la demande du locataire. Le juge a entendu les avocats de la société hier. "
    hindi = "अदालत ने किरायेदार का दावा खारिज कर दिया। न्यायाधीश ने कंपनी के वकील को सुना है। "
    rows = [(i, t, label) for i, (t, label) in enumerate([(english, "en"), (french, "fr"), (hindi, "hi")] * 12)]
    rows += [(100, english, "fr"), (101, french, None), (102, english + hindi, "en"), (103, english, "EN-GB"), (104, None, "en"), (105, "", None), (106, "123 — 456", None), (107, hindi, "und"), (108, "The deed calls it a “bail rural” here for the tenant.", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["status"], r["languages"]) for r in languages.document_languages(df).collect()}
    assert got[100] == ("wrong", ["en"]) and got[101] == ("missing", ["fr"]) and got[102] == ("mixed", ["en", "hi"]) and got[107] == ("no language", ["hi"])
    assert all(got[i][0] == "right" for i in [*range(36), 103, 108]) and not {104, 105, 106} & got.keys()
    assert languages.document_languages(df.where("false")).count() == 0


def test_languages_follow_the_labels(spark):
    # languages that the corpus holds are learned from its labels; a label that its own texts contradict is no language
    dutch = "De rechter heeft de vordering van de huurder afgewezen. De advocaat van het bedrijf werd gisteren gehoord. "
    swahili = "Mahakama ilikataa madai ya mpangaji huyo. Hakimu alimsikiliza wakili wa kampuni kwa muda mrefu. "
    english = "The court rejected the claim of the tenant. The judge heard the counsel for the company at length. "
    rows = [(i, t, label) for i, (t, label) in enumerate([(dutch, "nl"), (swahili, "sw"), (english, "en")] * 14)]
    rows += [(200 + i, english, "la") for i in range(6)] + [(300, swahili, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert languages.fit(df).languages == ("en", "nl", "sw")
    more = df.union(spark.createDataFrame([(1000 + i, english, "en") for i in range(200)], df.schema))
    assert languages.fit(more, 6).languages == ("en", "nl", "sw")  # as many sentences of the wrong label as of the right one
    got = {r["doc_id"]: (r["status"], r["languages"]) for r in languages.document_languages(df).collect()}
    assert got[300] == ("missing", ["sw"]) and got[200] == ("wrong", ["en"]) and all(got[i][0] == "right" for i in range(42))


def test_segments_join_neighbours(spark):
    rows = [(1, 0, 0, 5, "en", 0.9), (1, 1, 5, 9, "en", 0.8), (1, 2, 9, 12, "fr", 0.7), (1, 3, 12, 20, "en", 1.0), (2, 0, 0, 4, "fr", 0.6)]
    df = spark.createDataFrame(rows, "doc_id long, segment int, start int, end int, lang string, confidence double")
    got = sorted(tuple(r) for r in languages.joined_segments(df).collect())
    assert got == [(1, 0, 0, 9, "en", 0.8), (1, 1, 9, 12, "fr", 0.7), (1, 2, 12, 20, "en", 1.0), (2, 0, 0, 4, "fr", 0.6)]
    assert languages.joined_segments(df.where("false")).count() == 0
