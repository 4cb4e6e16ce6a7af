import random

from pyspark.sql import functions as F

from casewright.operators import reconcile

SCHEMA = "id string, v string, tags array<string>, m map<string,string>, d string, loaded_at int"
RULES = {"tags": reconcile.as_bag, "m": reconcile.as_entries, "d": reconcile.as_day}


def found(a, b):
    return {(r[0], r[1]) for r in reconcile.differences(a, b, "id", RULES, ("loaded_at",)).collect()}


def test_edge_cases(spark):
    a = spark.createDataFrame(
        [("1", "x", ["a", "b"], {"k": "v"}, "2001-02-03", 1), ("1", "x", ["a", "b"], {"k": "v"}, "2001-02-03", 2), ("2", None, None, None, None, 1), ("3", "y", ["a"], {}, "03-02-2001", 1), ("4", "z", ["a", "a"], {"k": None}, "x", 1), (None, "n", None, None, None, 1)],
        SCHEMA,
    )
    b = spark.createDataFrame(
        [("1", "x", ["b", "a"], {"k": "v"}, "03-02-2001", 9), ("2", "", [], {}, None, 1), ("4", "z", ["a"], {"k": "w"}, "x", 1), ("5", "new", None, None, None, 1)], SCHEMA
    )
    assert found(a, b) == {("2", "v"), ("3", "missing_in_copy"), ("4", "tags"), ("4", "m"), ("5", "missing_in_main")}
    assert found(a, a) == set()
    empty = a.where("false")
    assert found(empty, empty) == set()
    assert found(empty, b) == {(k, "missing_in_main") for k in "1245"}
    assert found(a.withColumn("bucket", F.lit(1)), b.withColumn("_key", F.lit(2))) == found(a, b)


def test_many_differences_in_a_bucket(spark):
    rng = random.Random(2)
    rows = [(str(i), str(rng.random()), None, None, None, 0) for i in range(3000)]
    other = [(r[0], r[1] if i % 3 else r[1] + "x", None, None, None, 0) for i, r in enumerate(rows) if i % 10]
    want = {(str(i), "missing_in_copy") for i in range(0, 3000, 10)} | {(str(i), "v") for i in range(3000) if i % 3 == 0 and i % 10}
    assert found(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)) == want
