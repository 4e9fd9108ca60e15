"""Benchmark: the wide-table builds, checks, export and whole pipeline.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "pipeline_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each timing is the median of ``$BENCH_REPEATS`` warm runs (one warm-up run
first; the JVM start is excluded).  Builds are timed with Spark's ``noop``
sink, so they measure the full plan without storage cost; ``checks`` and
``csv_export`` run the pipeline's reconciliation and export over stored
versions; ``pipeline`` is the whole run (build and write with layouts,
checks, publish, CSV export) below a fresh folder under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime
import json
import os
import re
import statistics
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from widelines.operators import access, checks, reports  # noqa: E402
from widelines.operators.catalog import service_parts_catalog  # noqa: E402
from widelines.operators.fact import sales_order_fact  # noqa: E402
from widelines.operators.line_items import sales_order_line_items  # noqa: E402
from widelines.plans.file_index import build_file_index, lookup  # noqa: E402
from widelines.plans.layouts import write_layout  # noqa: E402
from widelines.plans.pipeline import run_pipeline  # noqa: E402
from widelines.plans.sinks import export_csv  # noqa: E402
from widelines.session import build_session, scratch_path  # noqa: E402
from widelines.sources.fixtures import fixture_sources  # noqa: E402
from widelines.streaming.incremental import changed_since, refresh_fact  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    # below the session's spark.checkpoint.dir (a private folder only when unset)
    scratch = scratch_path(spark, "bench")
    src = fixture_sources(spark, sf_dir)

    def fact():
        noop(sales_order_fact(src))

    def lines():
        noop(sales_order_line_items(src))

    def catalog():
        noop(service_parts_catalog(src))

    # stored versions for the checks and the export (written once, untimed)
    stored_root = f"{scratch}/stored"
    stored, laid, laid_version = {}, {}, {}
    for name, df in (("sales_order_fact", sales_order_fact(src)),
                     ("sales_order_line_items", sales_order_line_items(src)),
                     ("service_parts_catalog", service_parts_catalog(src, ordered=False))):
        w = write_layout(df, stored_root, name)
        laid[name], laid_version[name] = spark.read.parquet(w.path), w.version
        stored[name] = laid[name].drop("order_year", "order_month")
    pool = ThreadPoolExecutor(max_workers=4)

    def check_pass():
        f, li = stored["sales_order_fact"], stored["sales_order_line_items"]
        jobs = [pool.submit(lambda: checks.reconcile_fact(src, f).first()),
                pool.submit(lambda: checks.reconcile_source(src, f).first()),
                pool.submit(lambda: checks.reconcile_lines(src, li).first()),
                pool.submit(lambda: checks.reconcile_counts(src, li).first())]
        rows = [j.result() for j in jobs]
        assert not any(rows.pop().asDict().values())
        issues = checks.reconciled_issues(*rows)
        assert not any(issues.values()) and checks.reconciled_financial_ok(rows[0], rows[1])

    def top10():
        reports.service_cost_top(service_parts_catalog(src, ordered=False)).collect()

    counter = {"n": 0}

    def export():
        counter["n"] += 1
        out = f"{scratch}/export{counter['n']}"
        jobs = []
        for name, df in stored.items():
            jobs.append(pool.submit(export_csv, df, out, name, datetime.date(2025, 12, 10)))
        assert all(j.result()[0] for j in jobs)

    def pipeline():
        counter["n"] += 1
        res = run_pipeline(spark, src, f"{scratch}/pipeline{counter['n']}")
        assert res.published, res

    def fact_by_date_range():
        access.by_date_range(laid["sales_order_fact"], datetime.date(1997, 1, 1),
                             datetime.date(1998, 1, 1)).write.format("noop").mode(
                                 "overwrite").save()

    def lines_by_item():
        probe = src.auto_parts.where(F.col("vendor") == "Brand#4").select(
            F.col("sku").alias("item_code"))
        noop(access.by_probe(laid["sales_order_line_items"], probe, "item_code"))

    def parts_demand():
        noop(reports.parts_demand(stored["sales_order_line_items"],
                                  stored["service_parts_catalog"]))

    def daily_rollup():
        reports.daily_rollup(stored["sales_order_fact"]).collect()

    def incremental_refresh():
        cutoff = datetime.datetime(2001, 1, 1)
        noop(refresh_fact(src, stored["sales_order_fact"], changed_since(src, cutoff)))

    # EXT-14: one question on the normalised and on the wide tables, and the comparison of all rows
    def state_revenue_normalized():
        reports.revenue_by_state_normalized(src).collect()

    def state_revenue_wide():
        reports.revenue_by_state_wide(stored["sales_order_fact"]).collect()

    def row_diff():
        assert reports.row_diff(stored["sales_order_fact"], sales_order_fact(src), "order_id").isEmpty()

    index_root, version = stored_root, laid_version["sales_order_line_items"]
    build_file_index(spark, index_root, "sales_order_line_items", version, ("order_id",), ("order_id",))
    some = [r[0] for r in stored["sales_order_fact"].select("order_id").orderBy(F.desc("total_amount")).limit(20).collect()]

    def lines_of_orders_indexed():
        noop(lookup(spark, index_root, "sales_order_line_items", "order_id", some))

    def lines_of_orders_scanned():
        noop(laid["sales_order_line_items"].join(spark.createDataFrame([(i,) for i in some], ["order_id"]), "order_id", "left_semi"))

    cases = {
        "sales_order_fact": fact,
        "sales_order_line_items": lines,
        "service_parts_catalog": catalog,
        "checks": check_pass,
        "service_cost_top10": top10,
        "csv_export": export,
        "pipeline": pipeline,
        "fact_by_date_range": fact_by_date_range,
        "lines_by_item": lines_by_item,
        "parts_demand": parts_demand,
        "daily_rollup": daily_rollup,
        "incremental_refresh": incremental_refresh,
        "state_revenue_normalized": state_revenue_normalized,
        "state_revenue_wide": state_revenue_wide,
        "row_diff": row_diff,
        "lines_of_orders_indexed": lines_of_orders_indexed,
        "lines_of_orders_scanned": lines_of_orders_scanned,
    }
    pipeline()  # warm-up: JIT, file listing caches, Python workers
    timings = {}
    for name, fn in cases.items():
        runs = []
        try:
            for _ in range(repeats):
                t0 = time.perf_counter()
                fn()
                runs.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - report, keep measuring the rest
            print(f"bench case {name} failed: {exc!r}"[:500], file=sys.stderr)
            timings[name] = None
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_sec",
        "value": timings["pipeline"],
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
