"""Sources: page lines, question sets, manifests, sample lists, metadata by year; each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CASES = "case_id string, name string, summary string, date date, court string, citations array<string>, bench array<string>, opinions array<struct<author:string,type:string,joined_by:array<string>>>, file string, outcome string, overrules array<string>, notes string"
QUESTIONS = "query string, case_id string, paragraphs array<int>, opinion_index int"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Case records of a YAML file with a list under `cases`; a file of records is small by nature."""
    import yaml

    with open(path, encoding="utf-8") as f:
        rows = (yaml.safe_load(f) or {}).get("cases") or []
    names = [x.split()[0] for x in "case_id name summary date court citations bench opinions file outcome overrules notes".split()]
    return spark.createDataFrame([tuple(r.get(n) if n != "opinions" else [tuple(o.get(k) for k in ("author", "type", "joined_by")) for o in r.get(n) or []] for n in names) for r in rows], CASES)


def questions(spark: SparkSession, path: str) -> DataFrame:
    """Questions of a YAML file with a list under `questions`; one paragraph may stand for a list, none is an empty list."""
    import yaml

    with open(path, encoding="utf-8") as f:
        rows = (yaml.safe_load(f) or {}).get("questions") or []
    listed = lambda p: [] if p is None else [p] if isinstance(p, int) else list(p)
    return spark.createDataFrame([(r["query"], r["case_id"], listed(r.get("paragraphs")), r.get("opinion_index")) for r in rows], QUESTIONS)


def sample_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A list of judgments in CSV files with a header."""
    return spark.read.option("header", True).schema(schema).csv(path)


def year_metadata(spark: SparkSession, base: str) -> DataFrame:
    """Metadata parquet of folders year=*: rows with a path that are available in English or do not say; years not there are skipped."""
    df = spark.read.option("basePath", base).parquet(f"{base}/year=*")
    return df.where(F.col("path").isNotNull() & F.coalesce("available_languages", F.lit("ENG")).contains("ENG"))


def question_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Question and answer pairs of a JSON array; either spelling of the date's name."""
    df = spark.read.option("multiLine", True).schema("case_name string, judgement_date string, judgment_date string, question string, answer string").json(path)
    return df.select("case_name", F.coalesce("judgement_date", "judgment_date").alias("date"), "question", "answer")


def documents_in(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, sha256, bytes) of the files of a folder, once each; content is hashed on the executors."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return df.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")).dropDuplicates(["path"])


def not_cached(found: DataFrame, cache: DataFrame, version: int, backend: str, ocr: bool) -> DataFrame:
    """Documents whose content no cache entry of this version, backend and mode covers; entries that still need reading don't count."""
    have = cache.where((F.col("version") == version) & (F.col("backend") == backend) & (F.col("ocr") == ocr) & ~F.coalesce("needs_ocr", F.lit(False)))
    return found.join(have.select("sha256").distinct(), "sha256", "left_anti")
