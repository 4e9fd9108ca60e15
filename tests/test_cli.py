"""The command line runs the pipeline and reports through its exit code."""

import json

from widelines.__main__ import main


def test_cli_publishes(spark, scratch, capsys):
    code = main(["--test-tables", "/root/testdata/sf0.001", "--out", scratch,
                 "--run-date", "2025-12-10"])
    report = json.loads(capsys.readouterr().out)
    assert code == 0 and report["published"] and report["failed_stage"] is None
    assert report["row_counts"]["sales_order_fact"] == 1500
    assert all(v == 0 for v in report["issues"].values())
    assert report["exports"]["sales_order_fact"].endswith("sales_order_fact_20251210.csv")


def test_cli_from_parquet_sources(spark, scratch, capsys):
    from widelines.sources.fixtures import fixture_sources
    from widelines.sources.parquet import read_sources, write_sources

    src = fixture_sources(spark, "/root/testdata/sf0.001")
    write_sources(src, f"{scratch}/db")
    back = read_sources(spark, f"{scratch}/db")
    for name, df in src.as_dict().items():
        got = back.as_dict()[name]
        assert got.schema == df.schema or [f.name for f in got.schema] == df.columns
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
    code = main(["--sources", f"{scratch}/db", "--out", f"{scratch}/out", "--no-export"])
    report = json.loads(capsys.readouterr().out)
    assert code == 0 and report["exports"] == {}
    assert report["row_counts"]["sales_order_line_items"] == 6000
