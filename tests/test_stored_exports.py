"""The lines' export runs no join: its shuffle files would lie beside the CSV."""

from widelines import registry

SF = "/root/testdata/sf0.001"


def test_lines_are_exported_from_a_stored_version(spark, monkeypatch):
    plans, export = [], registry.sinks.export_csv
    monkeypatch.setattr(registry.sinks, "export_csv", lambda df, *a, **kw: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or export(df, *a, **kw))
    got = registry.QUERIES["csv_roundtrip_line_items"](spark, SF)
    assert len(plans) == 1 and "Join" not in plans[0] and "Exchange" not in plans[0]
    want = registry.QUERIES["sales_order_line_items"](spark, SF)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
