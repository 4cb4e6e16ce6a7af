"""P4: differences between two copies of a table, by set reconciliation.

Rows are hashed into the field of 2**61 - 1 elements and dealt to buckets by their key. A bucket's set of hashes is
the polynomial with these roots; both sides evaluate theirs at the same few points. Where the values differ, the
quotient of the two polynomials is interpolated as a rational function, with a degree bound that doubles until spare
points confirm it: its numerator vanishes at the hashes that only the first side has, its denominator at those that
only the second has. Buckets beyond the largest bound are split and tried again. Only the rows found so are fetched
and compared field by field, which is exact: a wrongly named row costs time, never a wrong result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import field61
from ..sources.tables import checkpointed, table

BOUNDS, SPARE = (4, 8, 16, 32), 3
ROWS_A_BUCKET, PARTS, LEVELS = 16, 16, 6
#: Evaluation points: any distinct elements; multiples of an odd constant.
POINTS = [(0x1D8AF066A5C5B3F * (k + 1)) % field61.P for k in range(BOUNDS[-1] + SPARE)]


def exact(c: str, kind: str) -> Column:
    """A field as a string that is null only for null; arrays keep their order."""
    if kind.startswith("map"):
        return F.to_json(F.array_sort(F.map_entries(c)), {"ignoreNullFields": "false"})
    if kind.startswith(("array", "struct")):
        return F.to_json(F.col(c), {"ignoreNullFields": "false"})
    return F.col(c).cast("string")


def as_bag(c: str, kind: str) -> Column:
    """An array without regard to order, with repeats; null is empty."""
    return F.to_json(F.array_sort(F.coalesce(F.col(c), F.array().cast(kind))), {"ignoreNullFields": "false"})


def as_entries(c: str, kind: str) -> Column:
    """A map by its entries; null is empty."""
    return F.coalesce(exact(c, kind), F.lit("[]"))


def as_day(c: str, kind: str) -> Column:
    """The day that a text denotes, year first or day first; other text as it is."""
    return F.coalesce(
        F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.col(c), "yyyy-MM-dd").cast("string")),
        F.when(F.col(c).rlike(r"^\d{2}-\d{2}-\d{4}$"), F.try_to_date(F.col(c), "dd-MM-yyyy").cast("string")),
        F.col(c).cast("string"),
    )


def _canonical(df: DataFrame, key: str, fields: list[str], rules: Mapping) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_key"), F.struct(*[rules.get(c, exact)(c, kinds[c]).alias(c) for c in fields]).alias("_row")
    )


def _hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, fine, h, _key): fine deals a bucket's rows to parts when it must be split."""
    text = F.to_json("_row", {"ignoreNullFields": "false"})
    return rows.select(
        F.pmod(F.xxhash64("_key", F.lit(1)), F.lit(buckets)).alias("bucket"),
        F.xxhash64("_key", F.lit(2)).alias("fine"),
        F.pmod(F.xxhash64("_key", text) , F.lit(field61.P)).alias("h"),
        "_key",
    )


def _evaluated(hashes: DataFrame) -> DataFrame:
    """(bucket, n, at): size and values of each bucket's polynomial. Repeated rows count once.

    Rows come sorted by bucket, so a bucket is finished when the next begins and a task holds no more than one batch.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        points = np.array(POINTS, np.uint64)
        g, v, n = np.zeros(0, np.int64), np.zeros((0, len(POINTS)), np.uint64), np.zeros(0, np.int64)
        frame = lambda g, v, n: pd.DataFrame({"bucket": g, "n": n, "at": list(v.astype(np.int64))})
        for pdf in batches:
            if not len(pdf):
                continue
            h = pdf["h"].to_numpy().astype(np.uint64)
            factors = field61.reduce(points[None, :] + np.uint64(field61.P) - h[:, None])
            g, v, n = np.concatenate([g, pdf["bucket"].to_numpy()]), np.concatenate([v, factors]), np.concatenate([n, np.ones(len(pdf), np.int64)])
            sizes = np.add.reduceat(n, np.flatnonzero(np.append(True, g[1:] != g[:-1])))
            g, v = field61.products(g, v)
            n = sizes
            yield frame(g[:-1], v[:-1], n[:-1])
            g, v, n = g[-1:], v[-1:], n[-1:]
        if len(g):
            yield frame(g, v, n)

    one = hashes.select("bucket", "h").repartition("bucket").distinct().sortWithinPartitions("bucket")
    return one.mapInPandas(run, "bucket long, n long, at array<long>")


def _solved(first: DataFrame, second: DataFrame) -> DataFrame:
    """(bucket, only_first, only_second): the polynomials of each differing bucket, null where no bound was confirmed."""
    ones = F.lit(None).cast("array<long>")
    a, b = (_evaluated(x).select("bucket", F.col("n").alias(f"n{i}"), F.col("at").alias(f"at{i}")) for i, x in enumerate((first, second)))
    both = a.join(b, "bucket", "full").where(~(F.col("n0").eqNullSafe(F.col("n1")) & F.coalesce("at0", ones).eqNullSafe(F.coalesce("at1", ones))))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for bucket, n0, at0, n1, at1 in pdf[["bucket", "n0", "at0", "n1", "at1"]].itertuples(index=False):
                v0 = [int(x) for x in at0] if at0 is not None else [1] * len(POINTS)
                v1 = [int(x) for x in at1] if at1 is not None else [1] * len(POINTS)
                surplus = int(0 if n0 != n0 or n0 is None else n0) - int(0 if n1 != n1 or n1 is None else n1)
                use = [i for i in range(len(POINTS)) if v0[i] and v1[i]]
                points = [POINTS[i] for i in use]
                ratios = [v0[i] * pow(v1[i], -1, field61.P) % field61.P for i in use]
                found = None
                for bound in BOUNDS:
                    if abs(surplus) <= bound and bound + SPARE <= len(points):
                        found = field61.rational(points[: bound + SPARE], ratios[: bound + SPARE], surplus, bound)
                        if found:
                            break
                out.append((bucket, *(found or (None, None))))
            yield pd.DataFrame(out, columns=["bucket", "only_first", "only_second"])

    return both.mapInPandas(run, "bucket long, only_first array<long>, only_second array<long>")


def _vanishing(hashes: DataFrame, solved: DataFrame, which: str) -> DataFrame:
    """Keys of the rows whose hash is a root of their bucket's polynomial."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for pdf in batches:
            if not len(pdf):
                continue
            width = max(len(x) for x in pdf["poly"])
            coefficients = np.zeros((len(pdf), width), np.uint64)
            for i, x in enumerate(pdf["poly"]):
                coefficients[i, : len(x)] = np.asarray(x).astype(np.uint64)
            h, acc = pdf["h"].to_numpy().astype(np.uint64), np.zeros(len(pdf), np.uint64)
            for k in range(width - 1, -1, -1):
                acc = field61.reduce(field61.mul(acc, h) + coefficients[:, k])
            yield pdf.loc[acc == 0, ["_key"]]

    polys = solved.select("bucket", F.col(which).alias("poly")).where(F.size("poly") > 1)
    return hashes.join(polys, "bucket").select("_key", "h", "poly").mapInPandas(run, "_key string")


def differing_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    """Keys of the rows that only one side holds."""
    buckets = max(64, first.count() // ROWS_A_BUCKET)
    sides = [checkpointed(_hashed(first, buckets)), checkpointed(_hashed(second, buckets))]  # rows are read and serialised once for all hashes
    keys = None
    for level in range(LEVELS):
        solved = checkpointed(_solved(*sides))
        known = solved.where(F.col("only_first").isNotNull())
        for side, which in zip(sides, ("only_first", "only_second"), strict=True):
            more = _vanishing(side, known, which)
            keys = more if keys is None else keys.unionByName(more)
        open_ = solved.where(F.col("only_first").isNull()).select("bucket")
        if open_.isEmpty():
            break
        sides = [
            checkpointed(
                s.join(open_, "bucket", "left_semi").select(
                    F.xxhash64("bucket", F.pmod(F.xxhash64("fine", F.lit(level)), F.lit(PARTS))).alias("bucket"), "fine", "h", "_key"
                )
            )
            for s in sides
        ]
    else:
        for side in sides:  # what no bound settled is compared row by row
            keys = keys.unionByName(side.select("_key"))
    return keys.distinct()


def differences(first: DataFrame, second: DataFrame, key: str, rules: Mapping | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, field) for each record that only one side has (`missing_in_copy`: only first has it,
    `missing_in_main`: only second) and each field that differs.

    Compared are the columns that both tables have, without `ignore`; `rules` names columns that are compared in another
    form than exactly. Null equals only null unless a rule says otherwise. Repeated rows count once; if a key has rows
    of several contents, a field differs where the sets of its values differ. Rows with a null key are left out, and
    key values that are equal as text are equal. An empty table on one side makes all records of the other missing.
    """
    rules = rules or {}
    fields = [c for c in first.columns if c in second.columns and c != key and c not in ignore]
    a, b = _canonical(first, key, fields, rules), _canonical(second, key, fields, rules)
    keys = checkpointed(differing_keys(a, b))

    def fetched(side: DataFrame, name: str) -> DataFrame:
        rows = side.join(keys, "_key", "left_semi").distinct()
        values = [F.sort_array(F.collect_set(F.coalesce(F.concat(F.lit("="), F.col("_row")[c]), F.lit("-")))).alias(c) for c in fields]
        return rows.groupBy("_key").agg(F.struct(*values).alias(name))

    both = fetched(a, "x").join(fetched(b, "y"), "_key", "full")
    differs = [F.when(F.col("x")[c] != F.col("y")[c], F.lit(c)) for c in fields]
    found = (
        F.when(F.col("y").isNull(), F.array(F.lit("missing_in_copy")))
        .when(F.col("x").isNull(), F.array(F.lit("missing_in_main")))
        .otherwise(F.array_compact(F.array(*differs)))
    )
    return both.select(F.col("_key").alias("record_id"), F.explode(found).alias("field"))


PAIRS = {
    "cases": ("cases_copy", "case_id", {"conflicts": as_bag, "field_sources": as_entries}),
    "judgment_sample": ("judgment_sample_copy", "file", {"decision_date": as_day}),
}
IGNORED = ("updated_at", "loaded_at")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, (copy, key, rules) in PAIRS.items():
        found = differences(table(spark, sf_dir, name), table(spark, sf_dir, copy), key, rules, IGNORED)
        found = found.select(F.lit(name).alias("record_table"), "record_id", "field")
        out = found if out is None else out.unionByName(found)
    return out


def p4_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences by table and field."""
    return p4_found(spark, sf_dir).groupBy("record_table", "field").agg(F.count(F.lit(1)).alias("n"))


def _sql() -> str:
    day = "CASE WHEN regexp_full_match({0}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {0} WHEN regexp_full_match({0}, '\\d{{2}}-\\d{{2}}-\\d{{4}}') THEN {0}[7:10] || '-' || {0}[4:5] || '-' || {0}[1:2] ELSE {0} END"
    forms = {
        "conflicts": "list_sort(coalesce({0}, []))",
        "field_sources": "list_sort(coalesce(map_entries({0}), []))",
        "decision_date": day,
    }
    columns = {
        "cases": "case_name case_date court citations bench outcome overrules summary source missing conflicts field_sources case_number layout file",
        "judgment_sample": "path decision_year era title citation neutral_citation decision_date disposal bench author bench_size case_number criminal pages doc_length",
    }
    parts = []
    for name, (copy, key, _) in PAIRS.items():
        tests = [("missing_in_copy", f"b.{key} IS NULL"), ("missing_in_main", f"a.{key} IS NULL")]
        for c in columns[name].split():
            x, y = (forms.get(c, "{0}").format(f"{s}.{c}") for s in "ab")
            tests.append((c, f"a.{key} IS NOT NULL AND b.{key} IS NOT NULL AND ({x}) IS DISTINCT FROM ({y})"))
        for field, test in tests:
            parts.append(
                f"SELECT DISTINCT '{name}' AS record_table, coalesce(a.{key}, b.{key}) AS record_id, '{field}' AS field "
                f"FROM {name} a FULL JOIN {copy} b ON a.{key} = b.{key} WHERE {test}"
            )
    return " UNION ALL ".join(parts)


QUERIES = {"p4_found": p4_found, "p4_summary": p4_summary}
ORACLES = {
    "p4_found": _sql(),
    "p4_summary": f"SELECT record_table, field, count(*) AS n FROM ({_sql()}) GROUP BY 1, 2",
}
