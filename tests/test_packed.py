"""Texts of digits cross the network packed."""

import random

from builders import customer, make_sources, order, part, svc
from pyspark.sql import functions as F

from widelines.functions.text import pack_digits, unpack_digits
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import layouts

TEXTS = [None, "", "-", "--", "0", "00", "1-2-34-5678", "12-3", "A", "a", "F", "1F", "f", "12F", "AB", "ab", "C", "-F", "gone-17", "é1", " 1", "1.5"]


def test_packed_digits_give_every_text_back(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("0123456789-AFaf") for _ in range(rng.randrange(9))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    packed, rest = pack_digits("t")
    sent = df.select("i", "t", packed.alias("p"), rest.alias("r"))
    assert sent.where(~F.col("t").eqNullSafe(unpack_digits("p", "r"))).collect() == []
    short = sent.where("t rlike '^[0-9-]+$'")
    assert short.count() > 5 and short.where("r is not null or octet_length(p) > (octet_length(t) + 1) div 2").count() == 0


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_shuffled_lines_carry_packed_ids(spark):
    src = make_sources(spark, customers=[customer(1)], orders=[order(1, 1)],
                       parts=[part("1-1-7", 1, 2), part("odd id", 1, 1), part(None, 1, 1)], services=[svc("1-2", 1, 1)])
    small, large = sales_order_line_items(src), sales_order_line_items(src.with_tables(sales_order=src.sales_order), max_broadcast_rows=0)
    assert "unhex" in _plan(large) and "unhex" not in _plan(small)
    assert "Exchange" in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())) and small.count() == 4
    placed = layouts.arrange(small, layouts.LAYOUTS["sales_order_line_items"])
    assert "unhex" in _plan(placed) and placed.columns == [*small.columns, "order_year", "order_month"]
    assert sorted(str(r[:-2]) for r in map(tuple, placed.collect())) == sorted(str(tuple(r)) for r in small.collect())


def test_large_orders_are_not_joined_to_be_counted(spark):
    src = make_sources(spark, customers=[customer(1)], orders=[order(1, 1), order(2, 1)])
    sales_order_line_items(src, max_broadcast_rows=1)
    assert (("customers", "sales_order"), 1) not in src.probes and src.probes[("sales_order",), 1] is False
