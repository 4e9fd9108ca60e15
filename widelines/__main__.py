"""Command line: run the whole pipeline once (PIP-02).

    spark-submit --py-files widelines.zip -m widelines \\
        --test-tables /data/sf1            # derive the sources from the test tables
    python -m widelines --sources /lake/orders_db --out /lake/wide

Prints a JSON summary and exits 0 when the tables were published, 1 when a
build or a check failed (the previous versions then stay live).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pyspark.sql import SparkSession

from widelines.plans.pipeline import run_pipeline
from widelines.session import SCALE_CONF, scratch_path
from widelines.sources.fixtures import fixture_sources
from widelines.sources.parquet import read_sources


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="widelines", description=__doc__.splitlines()[0])
    src_group = ap.add_mutually_exclusive_group(required=True)
    src_group.add_argument("--sources", help="folder with one Parquet table per source")
    src_group.add_argument("--test-tables", help="folder of the TPC-H-like test tables")
    ap.add_argument("--out", help="output root (default: below spark.checkpoint.dir)")
    ap.add_argument("--run-date", help="YYYY-MM-DD stamped into export names (default: today)")
    ap.add_argument("--no-export", action="store_true", help="skip the CSV export")
    ap.add_argument("--gzip", action="store_true", help="compress the CSV export")
    ap.add_argument("--by-date", action="store_true", help="split order-grained exports into a folder per order day")
    ap.add_argument("--masked", action="store_true", help="mask customers' names, emails and phones in the export")
    ap.add_argument("--no-resume", action="store_true", help="build anew even if an earlier run stored builds")
    ap.add_argument("--pinned", action="store_true", help="store the sources first and run on that state")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("widelines")
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    src = (read_sources(spark, args.sources) if args.sources
           else fixture_sources(spark, args.test_tables))
    out = args.out or scratch_path(spark, "run")
    run_date = _dt.date.fromisoformat(args.run_date) if args.run_date else None
    result = run_pipeline(spark, src, out, run_date=run_date, export=not args.no_export,
                          compression="gzip" if args.gzip else None, by_date=args.by_date, masked=args.masked,
                          resume=not args.no_resume, pinned=args.pinned)
    print(json.dumps({
        "version": result.version,
        "published": result.published,
        "failed_stage": result.failed_stage,
        "row_counts": result.row_counts,
        "issues": result.issues,
        "financial_ok": result.financial_ok,
        "exports": result.exports,
        "export_files": {name: {k: m[k] for k in ("rows", "money", "bytes", "seconds")} | {"files": len(m["files"])}
                         for name, m in result.manifests.items()},
        "errors": result.errors,
        "resumed": result.resumed,
        "source_prints": result.source_prints,
        "seconds": {k: round(v, 3) for k, v in result.timings.items()},
        "out": out,
    }, indent=2))
    return 0 if result.published else 1


if __name__ == "__main__":
    sys.exit(main())
