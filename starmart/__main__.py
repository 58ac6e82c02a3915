"""Command line for the two stages, meant for ``spark-submit``.

    zip -r starmart.zip starmart
    spark-submit --py-files starmart.zip starmart/__main__.py build \\
        --raw-fact s3a://b/raw/2016-04 --code-lists s3a://b/labels \\
        --states s3a://b/states.csv --rates s3a://b/rates.csv --out s3a://b/runs/2016-04
    spark-submit --py-files starmart.zip starmart/__main__.py load \\
        --run s3a://b/runs/2016-04 --published s3a://b/published
    spark-submit --py-files starmart.zip starmart/__main__.py check --published s3a://b/published

Locally ``python -m starmart <command> ...`` does the same.

The session comes from the submit configuration; nothing is set here.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from starmart.operators.quality import check_report
from starmart.plans.publish import TableStore
from starmart.plans.stages import StarFiles, build_star_files, load_star_files
from starmart.schemas import REGISTRY


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starmart")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="stage 1: raw files -> star files of one run")
    b.add_argument("--raw-fact", required=True, nargs="+")
    b.add_argument("--code-lists", required=True, nargs="+")
    b.add_argument("--states", required=True, nargs="+")
    b.add_argument("--rates", required=True, nargs="+")
    b.add_argument("--out", required=True)
    ld = sub.add_parser("load", help="stage 2: merge, check and publish one run")
    ld.add_argument("--run", required=True)
    ld.add_argument("--published", required=True)
    c = sub.add_parser("check", help="null and duplicate keys of the published tables")
    c.add_argument("--published", required=True)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"starmart-{args.command}").getOrCreate()
    if args.command == "build":
        res = build_star_files(spark, args.raw_fact, args.code_lists, args.states, args.rates, args.out)
        print(json.dumps({"written": {n: c.written_rows for n, c in res.checks.items()},
                          "read_back_ok": all(c.passed for c in res.checks.values()),
                          "rejects": res.rejects}))
        return 0 if all(c.passed for c in res.checks.values()) else 1
    if args.command == "load":
        res = load_star_files(spark, TableStore(spark, args.published), StarFiles(args.run))
        print(json.dumps({"published": res.published, "tables": res.report_rows()}))
        return 0
    store = TableStore(spark, args.published)
    report = check_report({n: (store.current(s), list(s.keys)) for n, s in REGISTRY.items()})
    rows = [r.asDict() for r in report.collect()]
    print(json.dumps(rows))
    return 0 if all(r["passed"] for r in rows) else 1


if __name__ == "__main__":
    raise SystemExit(main())
