"""Case records: reading title blocks, merging what the text and the index say, and checking them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids
from ..functions import text as tx

#: Shapes of what a title block prints.
NEUTRAL = r"\b((?:19|20)\d\d)\s*(?:INSC|RNC)\s*(\d{1,4})\b"
CASE_NUMBER = r"(?i)\b((?:CRIMINAL|CIVIL|WRIT|SPECIAL LEAVE|TRANSFER|REVIEW|ORIGINAL|CURATIVE)[A-Z ().]*(?:APPEAL|PETITION|SUIT|CASE)S?[A-Z ().]*\s*NOS?\.?\s*[\d,\- &/]+(?:\s*OF\s*\d{4}|/\d{4})?)"
BENCH = r"\[([^\[\]]{3,200}?),?\s*(?:JJ?|C\.?J\.?I?)\.?\]"
KINDS = [
    (r"(?i)partly dissent|dissenting in part", "partly_dissenting"),
    (r"(?i)dissent", "dissenting"),
    (r"(?i)concur|agree", "concurring"),
    (r"(?i)for (?:himself|herself|themselves)|majority|speaking for", "majority"),
]


def title_block(head: Column) -> Column:
    """struct(petitioner, respondent, date, bench, case_number, neutral) read from the first lines of a judgment, an array."""
    lines = F.filter(F.transform(head, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    at = F.array_position(F.transform(lines, lambda x: F.lower(x).rlike(r"^(?:v\.?|vs\.?|versus)$")), F.lit(True)).cast("int")
    joined = F.array_join(lines, " ")
    inline = F.regexp_extract(F.coalesce(F.get(F.filter(lines, lambda x: x.rlike(r"(?i)\sv(?:s?\.|ersus)\s")), F.lit(0)), F.lit("")), r"(?i)^(.*?)\s+v(?:s?\.|ersus)\s+(.*?)(?:\s+on\s+\d.*)?$", 1)
    second = F.regexp_extract(F.coalesce(F.get(F.filter(lines, lambda x: x.rlike(r"(?i)\sv(?:s?\.|ersus)\s")), F.lit(0)), F.lit("")), r"(?i)^(.*?)\s+v(?:s?\.|ersus)\s+(.*?)(?:\s+on\s+\d.*)?$", 2)
    names = F.regexp_extract(joined, BENCH, 1)
    judges = F.filter(F.transform(F.split(names, r"\s*(?:,|\band\b|&)\s*"), tx.clean_judge), lambda x: F.length(x) > 2)
    return F.struct(
        F.nullif(tx.clean_party(F.when(at > 1, F.get(lines, at - 2)).otherwise(inline)), F.lit("")).alias("petitioner"),
        F.nullif(tx.clean_party(F.when(at > 0, F.get(lines, at)).otherwise(second)), F.lit("")).alias("respondent"),
        dates.parse_date(joined).alias("date"),
        judges.alias("bench"),
        F.nullif(tx.squash(F.regexp_extract(joined, CASE_NUMBER, 1)), F.lit("")).alias("case_number"),
        F.nullif(F.regexp_extract(joined, NEUTRAL, 0), F.lit("")).alias("neutral"),
    )


def opinion_kind(line: Column) -> Column:
    """Kind of an opinion that its opening line names; unknown for none."""
    out = None
    for pattern, kind in KINDS:
        out = F.when(line.rlike(pattern), kind) if out is None else out.when(line.rlike(pattern), kind)
    return out.otherwise("unknown")


def author_of(line: Column, bench: Column) -> Column:
    """The bench's member whose surname stands first in an opening line; null if none does."""
    words = F.split(F.regexp_replace(F.lower(line), "[^a-z ]", ""), r"\s+")
    places = F.transform(bench, lambda j: F.struct(F.array_position(words, tx.surname(j)).alias("at"), j.alias("name")))
    hits = F.array_sort(F.filter(places, lambda p: p["at"] > 0))
    return F.get(hits, F.lit(0))["name"]


def infer_majority(opinions: DataFrame) -> DataFrame:
    """opinions(case_id, opinion_index, kind, joined, bench_size) with the kinds that follow from the numbers: a sole opinion, and an
    unknown one joined by more than half the bench, are the majority's; where no kind is known at all, all are the court's."""
    by = opinions.groupBy("case_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("kind") != "unknown").alias("_named"))
    df = opinions.join(by, "case_id")
    more = (F.coalesce(F.size("joined"), F.lit(0)) + 1) * 2 > F.col("bench_size")
    kind = (
        F.when(F.col("_n") == 1, "majority")
        .when((F.col("kind") == "unknown") & F.coalesce(more, F.lit(False)), "majority")
        .when(F.col("_named") == 0, "majority")
        .otherwise(F.col("kind"))
    )
    return df.withColumn("kind", kind).drop("_n", "_named")


def merged(read: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """One record of each key: what the judgment itself says, else what the index says, with the source of each field and conflicts.

    read and index: key, parties, date, bench (array), citations (array), author. Sources are pdf, dataset, pdf+dataset,
    `pdf, dataset differs` and missing. Citations are joined, the judgment's first; a bench is the judgment's unless a name in it
    can't be a judge's. Rows of read decide which records there are.
    """
    some = lambda x, kind: F.when(F.size(x) > 0, x) if kind.startswith("array") else F.when(x.cast("string") != "", x)
    fields = ["parties", "date", "bench", "citations", "author"]
    kinds = dict(read.dtypes)
    a = read.select(key, *[some(F.col(f), kinds[f]).alias(f"a_{f}") for f in fields])
    b = index.select(key, *[some(F.col(f), kinds[f]).alias(f"b_{f}") for f in fields], F.lit(True).alias("b_is"))
    df = a.join(b, key, "left")
    plausible = F.forall("a_bench", lambda n: n.rlike(r"^[A-Z][A-Za-z.'\- ]{3,35}$"))
    df = df.withColumn("a_bench", F.when(plausible, F.col("a_bench")))
    folded = lambda x, kind: F.array_sort(F.transform(x, ids.slug)) if kind.startswith("array") else ids.slug(x.cast("string"))
    sources, out, clash = [], [], []
    for f in fields:
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        same = folded(x, kinds[f]) == folded(y, kinds[f])
        source = F.when(x.isNull() & y.isNull(), "missing").when(y.isNull(), "pdf").when(x.isNull(), "dataset").when(same | (F.lit(f == "citations")), "pdf+dataset").otherwise("pdf, dataset differs")
        sources += [F.lit(f), source]
        out.append((F.array_union(F.coalesce(x, F.array().cast("array<string>")), F.coalesce(y, F.array().cast("array<string>"))) if f == "citations" else F.coalesce(x, y)).alias(f))
        clash.append(F.when(source == "pdf, dataset differs", F.concat(F.lit(f"{f}: record says "), y.cast("string"))))
    return df.select(key, *out, F.create_map(*sources).alias("field_sources"), F.array_compact(F.array(*clash)).alias("conflicts"))


def checked(cases: DataFrame, texts: DataFrame) -> DataFrame:
    """(case_id, warning): details of a record that its judgment's text does not carry: the date in any form, the judges' surnames,
    the first party. Records without a detail, and cases without text, raise nothing for it."""
    df = cases.join(texts, "case_id")
    low = F.lower("text")
    day, month = F.date_format("date", "d"), F.date_format("date", "MMMM")
    forms = [F.concat_ws(" ", day, month), F.concat_ws(" ", month, day), F.date_format("date", "dd-MM-yyyy"), F.date_format("date", "dd.MM.yyyy"), F.date_format("date", "dd/MM/yyyy")]
    dated = F.lit(False)
    for f in forms:
        dated = dated | low.contains(F.lower(f))
    lost = F.filter("bench", lambda j: ~low.contains(tx.surname(j)))
    party = F.lower(F.get(F.split(F.split("name", r"(?i)\s+v(?:s?\.|ersus)\s+")[0], r"\s+"), F.lit(0)))
    tests = [
        F.when(F.col("date").isNotNull() & ~dated, F.lit("date not in the text")),
        F.when(F.size(lost) > 0, F.concat(F.lit("not in the text: "), F.array_join(lost, ", "))),
        F.when(~low.contains(party), F.lit("first party not in the text")),
    ]
    return df.select("case_id", F.explode(F.array_compact(F.array(*tests))).alias("warning"))


def flaws(cases: DataFrame) -> DataFrame:
    """(case_id, rule) of records that break a rule: required fields, form of the id, type of opinions, empty bench, repeated id."""
    kinds = ("majority", "concurring", "dissenting", "plurality", "partly_dissenting", "unknown")
    tests = [
        ("case_id is malformed", ~F.col("case_id").rlike("^[a-z0-9_]+$")),
        ("name is missing", F.coalesce(F.trim("name"), F.lit("")) == ""),
        ("court is missing", F.coalesce(F.trim("court"), F.lit("")) == ""),
        ("bench is empty", F.coalesce(F.size("bench"), F.lit(0)) <= 0),
        ("opinion type is unknown", F.coalesce(F.exists("opinion_types", lambda k: ~k.isin(*kinds)), F.lit(False))),
    ]
    broken = cases.select("case_id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(r)) for r, t in tests]))).alias("rule"))
    twice = cases.groupBy("case_id").count().where("count > 1").select("case_id", F.lit("repeated case_id").alias("rule"))
    return broken.unionByName(twice)


def prioritized(*sources: DataFrame, key: str) -> DataFrame:
    """One row a key: of several record tables with equal columns, the row of the first table that has the key."""
    out = None
    for i, df in enumerate(sources):
        part = df.withColumn("_rank", F.lit(i))
        out = part if out is None else out.unionByName(part)
    row = F.struct(*[F.col(c) for c in sources[0].columns])
    return out.groupBy(key).agg(F.min_by(row, "_rank").alias("r")).select("r.*")


#: Where a record's page holds its fields.
HTML_FIELDS = {"coram": r"(?s)Coram\s*:\s*(.*?)</strong>", "case_number": r"Case No :</span><font[^>]*>\s*(.*?)</font>", "bench_size": r"Bench :</span><font[^>]*>\s*(\d+)", "headnote": r"(?s)</strong><br>(.*?)<br><strong class='caseDetailsTD'"}
HEADNOTE_LENGTH = 600


def html_fields(html: Column) -> Column:
    """struct(bench, author, case_number, bench_size, headnote) of a record's HTML; the author is the first name with a star or a
    tooltip. What isn't there is null, the bench empty; null HTML has nothing."""
    part = lambda name: F.nullif(F.regexp_extract(F.coalesce(html, F.lit("")), HTML_FIELDS[name], 1), F.lit(""))
    pieces = F.split(F.coalesce(part("coram"), F.lit("")), ",")
    name = lambda x: F.trim(F.replace(tx.strip_html(x), F.lit("*"), F.lit("")))
    named = F.filter(F.transform(pieces, lambda x: F.struct(name(x).alias("name"), (x.contains("tooltip-sup") | tx.strip_html(x).contains("*")).alias("marked"))), lambda x: x["name"] != "")
    return F.struct(
        F.transform(named, lambda x: x["name"]).alias("bench"),
        F.get(F.filter(named, lambda x: x["marked"]), F.lit(0))["name"].alias("author"),
        F.nullif(tx.strip_html(part("case_number")), F.lit("")).alias("case_number"),
        part("bench_size").cast("int").alias("bench_size"),
        F.nullif(F.substring(tx.strip_html(part("headnote")), 1, HEADNOTE_LENGTH), F.lit("")).alias("headnote"),
    )


def authors_on_bench(opinions: DataFrame, cases: DataFrame) -> DataFrame:
    """(opinion_id, author, member): the first member of its case's bench with an opinion's author's surname, else null.

    opinions(opinion_id, case_id, author); cases(case_id, bench). Names meet only within a case, and likeness is asked only of
    those. Null authors and benches have no member.
    """
    seats = cases.select("case_id", F.posexplode("bench").alias("pos", "seat")).where("seat IS NOT NULL")
    asked = opinions.select("opinion_id", "case_id", "author")
    met = asked.where("author IS NOT NULL").join(seats, "case_id")
    found = met.where(tx.same_surname(F.col("author"), F.col("seat"))).groupBy("opinion_id").agg(F.min_by("seat", "pos").alias("member"))
    return asked.select("opinion_id", "author").join(found, "opinion_id", "left")
