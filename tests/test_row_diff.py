"""Row comparison by digests: planted differences, duplicates included."""

import random

from pyspark.sql import functions as F

from widelines.operators import reports

SCHEMA = "order_id long, name string, amount decimal(10,2)"


def _diff(spark, left, right, buckets=64):
    from decimal import Decimal
    fix = lambda rows: [(a, b, None if c is None else Decimal(c)) for a, b, c in rows]
    a, b = (spark.createDataFrame(fix(r), SCHEMA) for r in (left, right))
    return sorted(((r["side"], r["order_id"], r["name"], None if r["amount"] is None else str(r["amount"]))
                   for r in reports.row_diff(a, b, "order_id", buckets).collect()), key=str)


def test_planted_differences(spark):
    rows = [(i, f"n{i}", f"{i}.50") for i in range(500)]
    left = rows + [(7, "n7", "7.50"), (None, "x", None), (900, None, "1.00")]
    right = random.Random(1).sample(rows, 500)
    right[right.index((33, "n33", "33.50"))] = (33, "n33", "33.51")
    right += [(None, "x", None), (900, "", "1.00"), (901, None, None)]
    got = _diff(spark, left, right)
    assert sorted(map(str, got)) == sorted(map(str, [
        ("left", 7, "n7", "7.50"), ("left", 33, "n33", "33.50"), ("right", 33, "n33", "33.51"),
        ("left", 900, None, "1.00"), ("right", 900, "", "1.00"), ("right", 901, None, None)]))


def test_equal_sides_and_empty_sides(spark):
    rows = [(i % 10, "a", "1.00") for i in range(100)]
    assert _diff(spark, rows, rows[::-1]) == [] and _diff(spark, [], []) == []
    assert len(_diff(spark, rows, [])) == 100
    assert len(_diff(spark, rows + rows[:3], rows)) == 3


def test_values_that_swap_places_differ(spark):
    one = spark.createDataFrame([(1, None, "a"), (2, "b", "c")], "k long, x string, y string")
    two = spark.createDataFrame([(1, "a", None), (2, "c", "b")], "k long, x string, y string")
    assert reports.differing_buckets(one, two, "k", 4).count() == 2
    assert reports.row_diff(one, two, "k", 4).where(F.col("side") == "left").count() == 2


def test_rows_are_compared_in_one_pass(spark):
    rows = spark.createDataFrame([(1, "a")], "k long, x string")
    plan = reports.row_diff(rows, rows.limit(1), "k", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # each side's candidate rows once, for both directions
