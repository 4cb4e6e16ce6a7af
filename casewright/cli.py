"""Command line: run a query, validate a mapping, check and ingest cases, export passages, draw a sample, count nodes, search, evaluate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import load


def _session(master: str) -> SparkSession:
    return SparkSession.builder.master(master).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="casewright", description=__doc__)
    parser.add_argument("--data", help="folder of parquet tables")
    parser.add_argument("--master", help="Spark master")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of all queries")
    for name, extra in (("run", ["query"]), ("mapping", ["path"]), ("export", ["output"]), ("sample", ["output"]), ("counts", []), ("search", ["words"]), ("check", []), ("inspect", ["case"]), ("ingest", ["output"]), ("evaluate", []), ("questions", ["output"])):
        p = sub.add_parser(name)
        for e in extra:
            p.add_argument(e, nargs="+" if e == "words" else None)
        if name == "run":
            p.add_argument("--output")
        if name == "ingest":
            p.add_argument("--force", action="store_true", help="also cases that are rejected or duplicates")
            p.add_argument("--only-ok", action="store_true", help="no cases for review")
    args = parser.parse_args(argv)
    settings = load(data=args.data, master=args.master)
    from .plans import queries as core

    known = core.queries()
    if args.command == "list":
        print(*sorted(known), sep="\n")
        return 0
    spark = _session(settings.master)
    from .sources.shipping import ship

    ship(spark)
    if args.command == "mapping":
        from .operators import mapping

        bad = mapping.violations(mapping.read_mapping(spark, args.path)).persist()
        bad.orderBy("level", "provision").show(1000, False)
        return int(not bad.where("level = 'error'").isEmpty())
    settings.require("data")
    from .sources.tables import table

    if args.command == "run":
        df = known[args.query](spark, settings.data)
        df.write.mode("overwrite").parquet(args.output) if args.output else df.show(50, False)
    elif args.command == "export":
        from .plans import documents_q, pipeline, relational_q
        from .sources import sinks

        cases = table(spark, settings.data, "cases").select("case_id", "case_name", "court", "case_date", "citations", "bench", "summary")
        sinks.export_lines(pipeline.passages(documents_q.page_rows(spark, settings.data), cases, relational_q.examples(spark)), args.output)
    elif args.command == "sample":
        known["smp_balanced"](spark, settings.data).coalesce(1).write.mode("overwrite").option("header", True).csv(args.output)
    elif args.command == "check":
        states = known["qua_verdicts"](spark, settings.data).persist()
        states.groupBy("status").count().orderBy("status").show()
        states.where("status <> 'ok'").orderBy("status", "case_id").show(50, False)
    elif args.command == "inspect":
        known["seg_paragraphs"](spark, settings.data).where(F.col("doc_id") == args.case).orderBy("para_seq").show(200, False)
    elif args.command == "ingest":
        from .operators import quality

        states = known["qua_verdicts"](spark, settings.data).select("case_id", "status")
        cases = table(spark, settings.data, "cases").select("case_id", "file", F.sha2(F.coalesce("summary", "case_name"), 256).alias("doc_sha256")).dropDuplicates(["case_id", "file"])
        gated = quality.admitted(cases.join(states, "case_id"), args.force, args.only_ok).persist()
        gated.where("refused IS NOT NULL").groupBy("refused").count().show(20, False)
        passages = table(spark, settings.data, "chunks").dropDuplicates(["chunk_id"]).join(gated.where("refused IS NULL").select("case_id").distinct(), "case_id", "left_semi")
        passages.write.mode("overwrite").parquet(args.output)
    elif args.command == "evaluate":
        known["eval_search"](spark, settings.data).show(truncate=False)
        known["eval_misses"](spark, settings.data).show(20, False)
    elif args.command == "questions":
        known["smp_match"](spark, settings.data).coalesce(1).write.mode("overwrite").json(args.output)
    elif args.command == "counts":
        known["gr_unique"](spark, settings.data).show()
    elif args.command == "search":
        from .operators import vectors

        vectors.keyword_search(table(spark, settings.data, "chunks").select("chunk_id", "text"), "text", args.words).select("chunk_id", F.substring("text", 1, 120)).show(20, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
