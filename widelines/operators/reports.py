"""Reports over the wide tables: previews, summaries, rollups and analyses.

All are declarative aggregations; where a top-k is the feature the plan is
Spark's ``TakeOrderedAndProject`` (each task keeps its own k best, the
driver merges k x tasks rows), never a sort of the whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from widelines.functions.text import mask_email, mask_phone
from widelines.sources.model import Sources

PREVIEW_ROWS = 5
TOP_SERVICES = 10


def preview(df: DataFrame, *keys: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in key order (deterministic, unlike a bare LIMIT)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def line_items_by_type(lines: DataFrame) -> DataFrame:
    """AGG-05: line count and revenue per line type, type ascending (NULLs last)."""
    return (lines.groupBy("line_item_type")
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum("line_total").alias("total_revenue"))
            .orderBy(F.col("line_item_type").asc_nulls_last()))


def service_cost_top(catalog: DataFrame, n: int = TOP_SERVICES) -> DataFrame:
    """AGG-06 + SRT-03: services by total parts cost, descending with NULLs first."""
    return (catalog.groupBy("serviceid", "service")
            .agg(F.count(F.lit(1)).alias("parts_required"),
                 F.sum("parts_quantity_required").alias("total_parts_quantity"),
                 F.sum("total_parts_cost").alias("total_parts_cost"),
                 F.avg("labor_cost").alias("labor_cost"))
            .orderBy(F.col("total_parts_cost").desc_nulls_first(),
                     F.col("serviceid").asc_nulls_last())
            .limit(n))


def null_padding_profile(lines: DataFrame) -> DataFrame:
    """PRJ-07: non-NULL counts of the type-specific columns per line type."""
    return lines.groupBy("line_item_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("vendor").alias("vendor_values"),
        F.count("labor_minutes").alias("labor_minutes_values"),
        F.count("labor_cost").alias("labor_cost_values"),
        F.count("parts_cost").alias("parts_cost_values"),
    )


def _period_rollup(fact: DataFrame, unit: str, name: str) -> DataFrame:
    day = F.to_date("order_date")
    period = day if unit == "day" else F.trunc(day, unit)
    return (fact.groupBy(period.alias(name))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total_amount").alias("total_revenue"),
                 F.sum("subtotal").alias("total_subtotal"),
                 F.sum("tax").alias("total_tax"),
                 F.sum("parts_line_count").alias("parts_lines"),
                 F.sum("services_line_count").alias("services_lines")))


def daily_rollup(fact: DataFrame) -> DataFrame:
    """EXT-03: orders, money and line counts per day."""
    return _period_rollup(fact, "day", "order_day")


def monthly_rollup(fact: DataFrame) -> DataFrame:
    """EXT-03: the same per month."""
    return _period_rollup(fact, "month", "order_month")


def with_etl_timestamp(df: DataFrame, run_ts: str) -> DataFrame:
    """EXT-05: stamp rows with the run's timestamp, passed in so re-runs stay equal."""
    return df.withColumn("etl_timestamp", F.lit(run_ts).cast("timestamp_ntz"))


def masked_fact(fact: DataFrame) -> DataFrame:
    """EXT-07: fact with customer PII masked (email local part hashed, phone digits X'd)."""
    return fact.withColumns({
        "email": mask_email("email"),
        "phone": mask_phone("phone"),
        "last_name": F.concat(F.substring("last_name", 1, 1), F.lit(".")),
    })


def masked_lines(lines: DataFrame) -> DataFrame:
    """EXT-07 for the line items: the customer's email and name masked."""
    return lines.withColumns({
        "customer_email": mask_email("customer_email"),
        "customer_name": F.concat(F.substring("customer_name", 1, 1), F.lit(".")),
    })


def customer_order_history(lines: DataFrame) -> DataFrame:
    """EXT-08: each customer's orders with their line counts and amounts."""
    return lines.groupBy("customer_id", "order_id", "order_date", "invoice_number").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("line_item_type") == "PART").alias("part_lines"),
        F.count_if(F.col("line_item_type") == "SERVICE").alias("service_lines"),
        F.sum("line_total").alias("order_line_total"),
    )


def revenue_by_customer_product(lines: DataFrame) -> DataFrame:
    """EXT-09: revenue and units per (customer, item)."""
    return lines.groupBy("customer_id", "line_item_type", "item_code").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("total_revenue"),
    )


def revenue_by_type(lines: DataFrame) -> DataFrame:
    """EXT-09: revenue per line type and item description (part type / service category)."""
    return lines.groupBy("line_item_type", "item_description").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("total_revenue"),
    )


def sales_by_geography(fact: DataFrame) -> DataFrame:
    """EXT-10: orders, customers and revenue per (state, city)."""
    return fact.groupBy("state", "city").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("customer_id").alias("customer_count"),
        F.sum("total_amount").alias("total_revenue"),
    )


def parts_demand(lines: DataFrame, catalog: DataFrame,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """EXT-11: part units implied by the services sold.

    sum over service lines of quantity x required quantity equals, per
    (service, part), (units of the service sold) x (required quantity); so
    service lines are summed per service first and only then joined to the
    catalog.  The join is (services x parts per service), independent of
    how many lines were sold.

    Nearly every catalog row is a group of its own for the distinct count, so
    rows are dealt by part before they are grouped: a map-side table of groups
    would hold all rows of a task, beside those of the catalog's own grouping.
    A part has at most one row per service.  The stated number of partitions
    keeps AQE from merging them into few large ones.
    """
    tasks = int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sold = (lines.where(F.col("line_item_type") == "SERVICE")
            .groupBy(F.col("item_code").alias("serviceid"))
            .agg(F.sum("quantity").alias("service_units"),
                 F.count(F.lit(1)).alias("service_lines")))
    need = catalog.select("serviceid", "sku", "part_name", "vendor", "parts_quantity_required")
    return (need.join(broadcast_if_bounded(sold, max_broadcast_rows), "serviceid")
            .repartition(tasks, "sku")
            .groupBy("sku", "part_name", "vendor")
            .agg(F.sum(F.col("service_units") * F.col("parts_quantity_required"))
                 .alias("units_required"),
                 F.sum("service_lines").alias("service_lines"),
                 F.countDistinct("serviceid").alias("services_using_part")))


def order_mix(fact: DataFrame) -> DataFrame:
    """EXT-12: orders with parts only, services only, both, or no lines."""
    has_p = F.col("parts_line_count") > 0
    has_s = F.col("services_line_count") > 0
    mix = (F.when(has_p & has_s, "both").when(has_p, "parts_only")
           .when(has_s, "services_only").otherwise("none"))
    return fact.groupBy(mix.alias("order_mix")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("total_revenue"))


def revenue_by_state_normalized(src: Sources) -> DataFrame:
    """Revenue per state straight from the normalised tables (order -> customer)."""
    return (src.sales_order.select("customer_id", "total_amount")
            .join(src.customers.select("customer_id", "state"), "customer_id")
            .groupBy("state")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total_amount").alias("total_revenue")))


def revenue_by_state_wide(fact: DataFrame) -> DataFrame:
    """The same question on the wide table: no join."""
    return fact.groupBy("state").agg(F.count(F.lit(1)).alias("order_count"),
                                     F.sum("total_amount").alias("total_revenue"))


def normalized_equals_wide(src: Sources, fact: DataFrame) -> DataFrame:
    """EXT-14: both plans side by side per state, with an equality flag."""
    n = revenue_by_state_normalized(src).select(
        "state", F.col("order_count").alias("normalized_orders"),
        F.col("total_revenue").alias("normalized_revenue"))
    w = revenue_by_state_wide(fact).select(
        "state", F.col("order_count").alias("wide_orders"),
        F.col("total_revenue").alias("wide_revenue"))
    out = n.join(w, "state", "full")
    return out.withColumn(
        "equal",
        F.coalesce((F.col("normalized_orders") == F.col("wide_orders"))
                   & (F.col("normalized_revenue") == F.col("wide_revenue")), F.lit(False)))


def _row_print(columns: list[str], seed: int) -> F.Column:
    """A fingerprint of a whole row that tells NULL from every value."""
    return F.xxhash64(F.lit(seed), *(part for c in columns for part in (F.col(c).isNull(), F.col(c))))


def bucket_digests(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Per key bucket an order-free digest of its rows, duplicates included: count, XOR and sum of row fingerprints."""
    columns = sorted(df.columns)
    return (df.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"),
                      _row_print(columns, 1).alias("one"), _row_print(columns, 2).alias("two"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("one").alias("mixed"),
                                   F.sum(F.shiftright("two", 24)).alias("total")))


def differing_buckets(left: DataFrame, right: DataFrame, key: str, buckets: int) -> DataFrame:
    """Buckets whose digests differ, or that only one side has."""
    a = bucket_digests(left, key, buckets)
    b = bucket_digests(right, key, buckets).toDF("bucket", "rows_b", "mixed_b", "total_b")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in ("rows", "mixed", "total")])
    return a.join(b, "bucket", "full").where(~same).select("bucket")


def row_diff(left: DataFrame, right: DataFrame, key: str, buckets: int = 4096) -> DataFrame:
    """EXT-14 by rows: every row that one side has more often than the other, as often as it has it more, with
    ``side`` ('left' or 'right').

    Both sides are first reduced to digests per bucket of the key (one narrow
    aggregate a side, at most ``buckets`` rows); rows are shuffled and compared
    only in buckets whose digests differ.  More buckets make those smaller:
    about ten for each row expected to differ leave few equal rows to compare.
    Both directions come from one signed count per row, so each side is read
    and shuffled once for the comparison.
    """
    columns = left.columns
    right = right.select(*columns)
    differ = F.broadcast(differing_buckets(left, right, key, buckets))  # at most ``buckets`` rows of a long
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    a, b = (df.join(differ, bucket == F.col("bucket"), "left_semi").withColumn("_more", F.lit(sign))
            for df, sign in ((left, 1), (right, -1)))
    more = F.col("_more")
    return (a.unionByName(b).groupBy(*columns).agg(F.sum("_more").alias("_more")).where(more != 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs(more))))
            .select(*columns, F.when(more > 0, "left").otherwise("right").alias("side")))
