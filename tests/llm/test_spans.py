import random
from collections import defaultdict

from casewright.llm import spans


def text(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def brute(rows, least):
    at = defaultdict(set)
    for i, t in rows:
        for k in range(len(t or "") - least + 1):
            at[t[k : k + least]].add(i)
    return {(a, b) for v in at.values() for a in v for b in v if a < b}


def test_against_brute_force(spark):
    rng = random.Random(5)
    shared = [text(rng, n) for n in (199, 200, 201, 260, 700)]
    rows = []
    for i in range(60):
        t = text(rng, rng.randrange(0, 900))
        if i % 3 == 0:
            t += rng.choice(shared)
        if i % 4 == 0:
            t = rng.choice(shared) + t + rng.choice(shared)[:230]
        rows.append((f"c{i:02}", t))
    rows += [("dup1", rows[3][1] * 2), ("dup2", rows[3][1] * 2), ("rep", "z" * 900), ("rep2", "y" + "z" * 300), ("null", None), ("empty", ""), ("hot", shared[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(*rows[0], "again")], "id string, text string, tid string")
    got = {tuple(r) for r in spans.sharing_pairs(df, "id", "text").collect()}
    assert got == brute(rows, 200)
    shares = {r["id"]: r["shared_chars"] for r in spans.shared_share(df, "id", "text").collect()}
    at = defaultdict(set)
    for i, t in rows:
        for k in range(len(t or "") - 199):
            at[t[k : k + 200]].add(i)
    for i, t in rows:
        covered = set()
        for k in range(len(t or "") - 199):
            if len(at[t[k : k + 200]]) > 1:
                covered.update(range(k, k + 200))
        assert shares[i] == len(covered), i
    rows_ = spans.passage_classes(df, "id", "text").collect()
    classes, texts = {r["id"]: r["class_id"] for r in rows_}, dict(rows)
    links = {r["id"]: len({texts[b if a == r["id"] else a] for a, b in got if r["id"] in (a, b)} - {texts[r["id"]]}) for r in rows_}
    assert {r["id"]: r["links"] for r in rows_} == links
    assert all(classes[a] == classes[b] for a, b in got) and len(classes) == len(rows)
    assert spans.sharing_pairs(df.where("false"), "id", "text").count() == 0


def test_both_ways_of_holding_bands_agree(spark):
    rng = random.Random(8)
    shared = [text(rng, n) for n in (210, 300)]
    rows = [(f"c{i:02}", text(rng, 300) + shared[i % 2] * (i % 3) + text(rng, 90)) for i in range(40)] * 2
    df = spark.createDataFrame(rows, "id string, text string")
    got = []
    for held in (spans.HELD, 0):
        found = spans.Shared(df, "id", "text", held=held)
        got.append((sorted(map(tuple, found.pairs().collect())), sorted((bytes(r["tid"]), r["start"]) for r in found.windows.collect())))
    assert got[0] == got[1] and got[0][0]


def test_links_and_linear_work(spark):
    # a passage of many texts: as many windows as texts, and links are counted without pairs
    rng = random.Random(9)
    hot, cold = text(rng, 230), text(rng, 230)
    rows = [(f"h{i:04}", text(rng, 60) + chr(0x4E00 + i) + hot + chr(0x4E00 + i) + text(rng, 60) + chr(0x4E00 + i) + (cold if i < 3 else "")) for i in range(600)] + [("k", cold), ("n", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    assert spans.Shared(df, "id", "text").windows.count() == 31 * (600 + 4)
    got = {r["id"]: (r["class_id"], r["links"]) for r in spans.passage_classes(df, "id", "text").collect()}
    assert len({c for c, _ in got.values()}) == 2 and got["n"][1] == 0 and got["k"][1] == 3 and got["h0000"][1] == 600 and got["h0100"][1] == 599


def test_hot_passage_is_whole(spark):
    rng = random.Random(6)
    hot = text(rng, 220)
    rows = [(f"h{i:03}", text(rng, 50) + hot + text(rng, 50)) for i in range(80)]
    old = spans.HOT
    spans.HOT = 10
    try:
        assert spans.sharing_pairs(spark.createDataFrame(rows, "id string, text string"), "id", "text").count() == 80 * 79 // 2
    finally:
        spans.HOT = old


def test_texts_that_share_nothing(spark):
    # no band collides, in some parts of the texts or in all
    rng = random.Random(10)
    rows = [(f"u{i:02}", text(rng, 400)) for i in range(30)]
    none = spark.createDataFrame(rows, "id string, text string").repartition(3)
    two = none.unionByName(spark.createDataFrame([("a", rows[0][1][:300] + "x"), ("b", "y" * 250)], "id string, text string"))
    for held in (spans.HELD, 0):
        assert spans.Shared(none, "id", "text", held=held).pairs().count() == 0
        assert spans.Shared(two, "id", "text", held=held).pairs().count() == 1
    assert spans.sharing_pairs(none, "id", "text").count() == 0
    assert {r["shared_chars"] for r in spans.shared_share(none, "id", "text").collect()} == {0}
    assert {r["links"] for r in spans.passage_classes(none, "id", "text").collect()} == {0}
