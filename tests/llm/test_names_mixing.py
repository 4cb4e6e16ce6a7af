from pyspark.sql import functions as F

from casewright.llm import mixing, names

REGISTER = [("J1", "Anthony Vashobhat"), ("J2", "Benjamin Vikram Yethulkar"), ("J3", "Padmini Yethulkar"), ("J4", "Rajendra Koroprak"), ("J5", "Tarun Baskuvalli"), ("J6", "Twin Samename"), ("J7", "Twin Samename"), (None, "No Key"), ("J8", None)]


def test_names(spark):
    mean = {
        "Justice Anthony Vashobhat": "J1", "VASHOBHAT J": "J1", "B.V. Yethulkar": "J2", "Yethulkar, B. V.": "J2", "BV Yethulkar": "J2", "Benjmin Vikram Yetulkar": "J2", "Yethulkar Padmini": "J3",
        "Raju Koroprak": "J4", "Hon’ble Mr. Justice R. Koropark": "J4", "Tar. Baskuvalli": "J5", "Baskoovalli, T.": "J5", "Anthony Vashobhat": "J1",
    }
    none = ["Yethulkar", "Zubin Vashobhat", "Qamar Mordoldi", "", "  ", None, "J.", "Twin Samename", "123", "Anthony X. Y. Vashobhat"]
    df = spark.createDataFrame([(n,) for n in [*mean, *none, *mean]], "name string")
    reg = spark.createDataFrame(REGISTER, "judge_id string, full_name string")
    got = {r["name"]: r["judge_id"] for r in names.link_names(df, reg).collect()}
    assert got == mean
    assert names.link_names(df.where("false"), reg).count() == 0 and names.link_names(df, reg.where("false")).count() == 0


def test_linkage_decides(spark):
    # an initial fits both judges; the spellings around it are one judge's
    reg = spark.createDataFrame([("J1", "Meera Anandkumar Koroprak"), ("J2", "Mohan Anandkumar Koroprak")], "judge_id string, full_name string")
    near = ["M. Anandk. Koroprak", "Moha. Anandk. Koroprak"]
    df = spark.createDataFrame([(n,) for n in near], "name string")
    old = names.average_linkage
    got = {r["name"]: r["judge_id"] for r in names.link_names(df, reg).collect()}
    names.average_linkage = lambda n, pairs, least=2.0: old(n, pairs, least)  # every name a group of its own
    try:
        alone = {r["name"]: r["judge_id"] for r in names.link_names(df, reg).collect()}
    finally:
        names.average_linkage = old
    assert got == dict.fromkeys(near, "J2") and alone == {near[1]: "J2"}


def test_average_linkage_against_one_by_one(spark):
    import itertools
    import random

    rng = random.Random(4)
    ids = [f"n{i:02}" for i in range(14)]
    sims = {(a, b): rng.random() for a, b in itertools.combinations(ids, 2) if rng.random() < 0.6}
    groups = [{i} for i in ids]
    mean = lambda g, h: sum(sims.get((min(a, b), max(a, b)), 0) for a in g for b in h) / (len(g) * len(h))
    while len(groups) > 1:
        m, g, h = max(((mean(g, h), sorted(g), sorted(h)) for g, h in itertools.combinations(groups, 2)), key=lambda x: x[0])
        if m < 0.35:
            break
        groups = [x for x in groups if x not in (set(g), set(h))] + [set(g) | set(h)]
    got = {}
    for r in names.average_linkage(spark.createDataFrame([(i,) for i in ids], "name string"), spark.createDataFrame([(a, b, s) for (a, b), s in sims.items()], "name string, other string, cosine double")).collect():
        got.setdefault(r["group"], set()).add(r["name"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups))


def test_alike_loses_no_pair(spark):
    near = ["Anthony Vashobhat", "Antony Vashobhat", "A. Vashobhat", "Benjamin Yethulkar", "Benjmin Yetulkar", "Padmini Yethulkar", "Vashobat Anthony"]
    df = spark.createDataFrame([(n,) for n in near], "name string")
    weights = df.select(F.explode(names.grams(F.col("name"))).alias("gram")).groupBy("gram").agg((F.log(8.0 / F.count(F.lit(1))) + 0.1).alias("idf"))
    v = names.vectors(df, weights)
    brute = {(r["name"], r["other"]) for r in names.similar(v, v, None, 0.5).where("name < other").collect()}
    assert {(r["name"], r["other"]) for r in names.alike(v.withColumn("block", F.lit(1)), 99, 0.5).collect()} == brute


def test_short_forms():
    for a, b in (("raju", "rajendra"), ("benny", "benjamin"), ("tony", "anthony"), ("becky", "rebecca"), ("lottie", "charlotte"), ("shyam", "ghanshyam"), ("bob", "robert"), ("kate", "katherine"), ("venky", "venkatesh")):
        assert names.short_form(a, b), (a, b)
    for a, b in (("zubin", "anthony"), ("usha", "sunanda"), ("farida", "padmini"), ("bill", "robert")):
        assert not names.short_form(a, b), (a, b)


def test_flow():
    total, routes = mixing.plan({("a",): 100, ("b",): 100, ("a", "b"): 50}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})
    assert total == 250 and sum(routes.values()) >= 248
    total, routes = mixing.plan({("a",): 100, ("b",): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 3})
    assert 58 <= total <= 61
    assert mixing.plan({("a",): 100}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})[0] <= 1


def test_mix(spark):
    docs = [(i, f"word {i} and some more text for it", "big") for i in range(300)] + [(1000 + i, f"small {i} has its own text too", "small") for i in range(40)]
    docs += [(2000, None, "big"), (2001, "", "small"), (2002, "x y", None), (2003, "x y", "other"), (2004, "word 1 and some more text for it", "small"), (2005, docs[3][1], "big")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 4)], "source string, target_share double, max_repeats int")
    got = mixing.mix(df, targets)
    rows = got.collect()
    assert {r["source"] for r in rows} == {"big", "small"} and all(r["uses"] <= (1 if r["source"] == "big" else 4) for r in rows)
    assert len({(r["doc_id"], r["source"]) for r in rows}) == len(rows)
    share = {r["source"]: r["share"] for r in mixing.shares_reached(got, targets).collect()}
    assert abs(share["big"] - 0.6) < 0.02
    assert mixing.mix(df.where("false"), targets).count() == 0
    more = spark.createDataFrame([("big", 0.3, 1), ("small", 0.2, 4), ("absent", 0.5, 2)], targets.schema)
    part = {r["source"]: (r["share"], r["shortfall"]) for r in mixing.shares_reached(mixing.mix(df, more), more).collect()}
    assert abs(part["big"][0] - 0.6) < 0.02 and part["absent"] == (0.0, 0.5)
    assert sorted(map(tuple, mixing.mix(df, targets).collect())) == sorted(map(tuple, rows))
