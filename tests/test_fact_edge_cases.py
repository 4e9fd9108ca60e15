"""FIXTURES section 4: hand-made orders with literal expected values."""

from decimal import Decimal

from pyspark.sql import functions as F

from builders import customer, fanned_out_fact, make_sources, order, part, svc
from widelines.operators.fact import sales_order_fact
from widelines.schemas import SALES_ORDER_FACT


def _edge_sources(spark):
    return make_sources(
        spark,
        customers=[customer(1), customer(2, phone=None)],
        orders=[order(1, 1), order(2, 1), order(3, 1), order(4, 2), order(5, 2),
                order(6, 99)],  # order 6: unknown customer
        parts=[part("p2a", 2, 2), part("p2b", 2, 3),
               part("p4a", 4, 2), part("p4b", 4, 3),
               part("p5a", 5, None)],
        services=[svc("s3a", 3, 4),
                  svc("s4a", 4, 1), svc("s4b", 4, 1), svc("s4c", 4, 1),
                  svc("s5a", 5, 2)],
    )


def _by_order(df):
    return {r["order_id"]: r for r in df.collect()}


def test_fact_as_written(spark):
    rows = _by_order(sales_order_fact(_edge_sources(spark)))
    assert set(rows) == {1, 2, 3, 4, 5}  # order 6 has no customer: inner join drops it
    expect = {  # parts count, services count, parts qty, services qty
        1: (0, 0, 0, 0),
        2: (2, 0, 5, 0),
        3: (0, 1, 0, 4),
        4: (2, 3, 15, 6),  # fan-out: 5 x 3 and 3 x 2
        5: (1, 1, 0, 2),   # NULL part quantity sums to 0
    }
    for oid, (pc, sc, pq, sq) in expect.items():
        r = rows[oid]
        assert (r.parts_line_count, r.services_line_count, r.total_parts_quantity,
                r.total_services_quantity) == (pc, sc, pq, sq), oid
        assert r.total_line_items == pc + sc
    assert rows[4].phone is None


def test_fact_true_quantities(spark):
    rows = _by_order(sales_order_fact(_edge_sources(spark), true_quantities=True))
    assert (rows[4].total_parts_quantity, rows[4].total_services_quantity) == (5, 3)
    assert (rows[2].total_parts_quantity, rows[3].total_services_quantity) == (5, 4)


def test_fact_schema(spark):
    df = sales_order_fact(_edge_sources(spark))
    assert [(f.name, f.dataType) for f in df.schema] == \
        [(f.name, f.dataType) for f in SALES_ORDER_FACT]


def test_rewrite_equals_naive_join(spark):
    """The pre-aggregated plan equals the fan-out join grouped on every column."""
    src = _edge_sources(spark)
    naive = fanned_out_fact(src)
    ours = sales_order_fact(src)
    assert ours.exceptAll(naive).count() == 0
    assert naive.exceptAll(ours).count() == 0


def test_repeated_line_ids_counted_once(spark):
    """Distinct counts use line ids; the fan-out factor uses row counts."""
    src = make_sources(spark, customers=[customer(1)], orders=[order(1, 1)],
                       parts=[part("p", 1, 2), part("p", 1, 3)],
                       services=[svc("s1", 1, 1), svc("s2", 1, 1)])
    r = sales_order_fact(src).first()
    assert r.parts_line_count == 1 and r.services_line_count == 2
    assert r.total_parts_quantity == 5 * 2 and r.total_services_quantity == 2 * 2


def test_money_stays_decimal(spark):
    df = sales_order_fact(_edge_sources(spark))
    total = df.agg(F.sum("total_amount").alias("t")).first().t
    assert isinstance(total, Decimal) and total == Decimal("540.00")
