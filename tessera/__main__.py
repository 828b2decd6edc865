"""python -m tessera index|summary|keywords|neural|worklist ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import runs
from .operators import ports
from .sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="run", required=True)
    a = sub.add_parser("index")
    source = a.add_mutually_exclusive_group(required=True)
    source.add_argument("--payloads")
    source.add_argument("--workbooks")
    a.add_argument("--years", type=int, nargs="*", default=[])
    a.add_argument("--start-from", type=int, default=0)
    a.add_argument("--dump")
    a = sub.add_parser("summary")
    for name in ("--index", "--downloads", "--extractions"):
        a.add_argument(name, required=True)
    for name in ("keywords", "neural"):
        a = sub.add_parser(name)
        a.add_argument("--summary", required=True)
        a.add_argument("--texts", required=True)
        a.add_argument("--overwrite", action="store_true")
        if name == "neural":
            a.add_argument("--taxonomy", required=True)
            a.add_argument("--no-qa", action="store_true")
            a.add_argument("--run-id")
            a.add_argument("--stand-ins", action="store_true", help="run on stand-in models, whose disclosures are invented")
    a = sub.add_parser("worklist")
    a.add_argument("--log", required=True)
    a.add_argument("--only")
    a.add_argument("--exact", action="store_true")
    for name, a in sub.choices.items():
        a.add_argument("--out", required=True)
        if name != "summary":
            a.add_argument("--limit", type=int)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    o = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    if o.run == "index":
        runs.build_index(spark, runs.IndexOptions(o.out, o.payloads, o.workbooks, tuple(o.years), o.start_from, o.limit, o.dump))
    elif o.run == "summary":
        runs.summarise(spark, runs.SummaryOptions(o.index, o.downloads, o.extractions, o.out)).show()
    elif o.run == "worklist":
        runs.worklist(spark, o.log, o.out, o.only, o.limit, o.exact)
    else:
        options = runs.TextOptions(o.summary, o.texts, o.out, o.limit, o.overwrite)
        if o.run == "keywords":
            runs.analyse(spark, options).show()
        else:
            # A deployment passes its own ports to runs.disclose().
            if not o.stand_ins:
                raise SystemExit("no model ports: call runs.disclose() with those of a deployment, or try it with --stand-ins")
            answer = None if o.no_qa else ports.answer(ports.number_answerer)
            runs.disclose(spark, options, files.taxonomy_of(spark, files.prompt(o.taxonomy)), ports.embed(ports.hashed_embedder(256)), ports.entailment(ports.overlap_entailment), answer, o.run_id).show()


if __name__ == "__main__":
    main()
