"""python -m quirelight.cli COMMAND: the stages over Parquet tables of pages or spans, and the tools around them.

census, segment (with --spans refined by font sizes), units, titles, labels; freeze (the term table), evaluate (decisions
against a table of true seams), policies, verify."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quirelight import contracts
from quirelight.operators import assemble as A
from quirelight.operators import census as N
from quirelight.operators import features as M
from quirelight.operators import identity as I
from quirelight.operators import segment as S
from quirelight.operators import term_deltas as D
from quirelight.operators import validation as V
from quirelight.sources.files import write_records


def main(args: list[str] | None = None) -> int:
    cli = argparse.ArgumentParser(prog="quirelight")
    cli.add_argument("command", choices=["census", "segment", "units", "titles", "title-records", "labels", "freeze", "add-terms", "build-terms", "evaluate", "policies", "verify"])
    cli.add_argument("--input", help="Parquet of pages (census, segment, evaluate), spans (units, titles, title-records, labels) or of document_id and text (freeze, add-terms)")
    cli.add_argument("--output", help="folder for JSON records, of the frozen term table (freeze), or of its deltas (add-terms, build-terms)")
    cli.add_argument("--version", help="name of the term table's version, whose folder --terms takes (build-terms)")
    cli.add_argument("--policy", default="balanced", choices=sorted(contracts.load("segmentation")["policies"]))
    cli.add_argument("--spans", help="Parquet of document_id, page, text, font_size: font sizes refine what is in the balance (segment)")
    cli.add_argument("--terms", help="folder of a frozen term table; without one all terms are equally rare (labels)")
    cli.add_argument("--truth", help="Parquet of document_id, before_page, is_seam for every seam (evaluate)")
    cli.add_argument("--validate", action="store_true", help="fail if what is written breaks a rule: required fields, numbers that can't be, segments that don't tile their documents")
    cli.add_argument("--report", action="store_true", help="print counts of what was written")
    a = cli.parse_args(args)
    if a.command == "policies":
        for name, threshold in contracts.load("segmentation")["policies"].items():
            print(name, threshold)
        return 0
    if a.command == "verify":
        found = contracts.verify()
        for name, finding in found:
            print(name, finding)
        return int(bool(found))
    spark = SparkSession.builder.getOrCreate()
    if a.command == "build-terms":
        print(D.build_version(spark, a.output, a.version))
        return 0
    rows, rules = spark.read.parquet(a.input), {}
    if a.command == "add-terms":
        print(D.add_delta(rows, a.output))
        return 0
    if a.command == "freeze":
        I.freeze(rows, a.output)
        return 0
    if a.command == "census":
        found, rules = N.census(rows), V.PAGES
    elif a.command in ("segment", "evaluate"):
        census = N.census(rows)
        pairs = S.seams(census)
        scores = S.refined(pairs, S.histogram(spark.read.parquet(a.spans), ["document_id", "page"]), a.policy) if a.spans else S.scored(S.signals(pairs))
        decisions = S.decided(scores, a.policy)
        if a.command == "evaluate":
            found = S.evaluation(decisions, spark.read.parquet(a.truth), [])
        else:
            found, rules = S.rejoined(S.segments(decisions, census), census), V.SEGMENTS
            if a.validate:
                found = V.with_neighbours(found, census.groupBy("document_id").agg(F.max("page").alias("total")))
    elif a.command == "units":
        found, rules = A.units(rows), V.UNITS
    elif a.command == "titles":
        found = M.titles(M.title_scores(M.matrix(A.units(rows))))
    elif a.command == "title-records":
        found = M.title_records(M.title_scores(M.matrix(A.units(rows))))
    else:
        found = I.elected(I.fused(A.units(rows), *I.thaw(spark, a.terms)))
    rules = rules if a.validate else {}
    documents = {"documents": F.approx_count_distinct("document_id")} if "document_id" in found.columns else {}
    found, seen = V.observed(found, rules, **documents)
    write_records(found.drop("previous_end", "is_last", "total"), a.output)
    if a.report:
        counts = seen.get
        print(f"{a.command}: {counts['rows']} records" + (f", about {counts['documents']} documents" if documents else ""))
    wrong = V.broken(seen, rules)
    for name, n in wrong.items():
        print(f"{name}: {n} records", file=sys.stderr)
    return int(bool(wrong))


if __name__ == "__main__":
    sys.exit(main())
