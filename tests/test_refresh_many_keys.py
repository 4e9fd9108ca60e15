"""A refresh of more orders than are broadcast: the same tables, and rows of other orders stay where they are."""

from test_partition_refresh import CHANGED, _after, _before, _load, _same

from widelines.functions.keysets import KeySet
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import sinks
from widelines.schemas import WIDE
from widelines.streaming.incremental import refresh_partitions


def test_refresh_with_many_changed_orders(spark, scratch, monkeypatch):
    made, marked = [], KeySet._marked
    monkeypatch.setattr(KeySet, "_marked", lambda self, df: made.append(marked(self, df)) or made[-1])
    after = _after(spark)
    _load(spark, scratch, _before(spark))
    refresh_partitions(spark, after, scratch, spark.createDataFrame(CHANGED, "order_id long"), max_broadcast_rows=0)
    assert len(made) > 4 and all(m is not None for m in made)
    for name, build in (("sales_order_fact", sales_order_fact), ("sales_order_line_items", sales_order_line_items)):
        assert _same(sinks.read_current(spark, scratch, name, WIDE[name]), build(after))
