"""The example views of the source schemas as queries over the supplied tables.

Money and rates are summed as decimals, so results do not depend on the order in which tasks finish. Facts are
reduced by their join key before they meet a dimension wherever the grouping allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.sources.derived import table

# The order in which open work is listed, most urgent first; anything else sorts before them.
PRIORITY_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _double(c: Column) -> Column:
    return c.cast("double")


def _revenue() -> Column:
    return _money("l_extendedprice")


def _profit() -> Column:
    return _money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))


def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal"
    )


def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    keys = ("o_orderkey", "c_name", "c_mktsegment", "o_orderdate", "o_orderstatus", "o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("item_count"))
    )


def product_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum(_money("l_quantity")).alias("total"), F.count("l_quantity").alias("n"))
    )
    n = F.coalesce(F.sum("n"), F.lit(0))
    return (
        table(spark, sf_dir, "part")
        .join(ratings, F.col("p_partkey") == F.col("l_partkey"), "left")
        .groupBy("p_partkey", "p_name", "p_brand", "p_retailprice")
        .agg(
            F.coalesce(F.try_divide(_double(F.sum("total")), F.sum("n")), F.lit(0.0)).alias("avg_quantity"),
            n.alias("line_count"),
        )
    )


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are first reduced to one row per order and category; distinct orders are then a plain count."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").where(~F.col("o_orderstatus").isin("P")).select("o_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("p_type", "o_orderkey")
        .agg(F.sum(_revenue()).alias("revenue"))
        .groupBy("p_type")
        .agg(F.count("*").alias("order_count"), _double(F.sum("revenue")).alias("total_revenue"))
    )


def daily_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("user_id is not null")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.countDistinct("user_id").alias("dau"))
    )


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "medium").otherwise("high")
    return (
        table(spark, sf_dir, "events")
        .where("event_type <> 'view'")
        .groupBy("event_type", severity.alias("severity"))
        .agg(F.count("*").alias("occurrences"), F.max("ts").alias("last_seen"))
    )


def headcount_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .groupBy("c_nationkey")
        .agg(F.count("c_custkey").alias("n"), F.sum(_money("c_acctbal")).alias("total"))
    )
    return (
        table(spark, sf_dir, "nation")
        .join(staff, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select(
            "n_nationkey",
            "n_name",
            F.coalesce("n", F.lit(0)).alias("headcount"),
            (_double(F.col("total")) / F.col("n")).alias("avg_balance"),
        )
    )


def active_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .where("s_acctbal > 0")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "n_name", "s_acctbal")
    )


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are reduced to one row per order before they are joined to the order's date."""
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(_revenue()).alias("revenue"), F.sum(_profit()).alias("profit"), F.count("*").alias("n"))
    )
    dates = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    return (
        per_order.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("year", "month")
        .agg(
            _double(F.sum("revenue")).alias("revenue"),
            _double(F.sum("profit")).alias("profit"),
            F.sum("n").alias("transactions"),
        )
    )


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum(_money("l_quantity")).alias("units"),
            F.sum(_revenue()).alias("revenue"),
            F.sum(_profit()).alias("profit"),
        )
    )
    return (
        table(spark, sf_dir, "part")
        .join(per_part, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy("p_name", "p_type", "p_brand")
        .agg(
            _double(F.sum("units")).alias("units_sold"),
            _double(F.sum("revenue")).alias("revenue"),
            _double(F.sum("profit")).alias("profit"),
        )
    )


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.date_diff(F.lit("2003-01-01").cast("date"), F.to_date("o_orderdate"))
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.sum(_money("o_totalprice")).alias("spent"), F.sum(age).alias("age"))
    )
    tier = F.when(F.col("c_acctbal") < 0, "debtor").when(F.col("c_acctbal") < 5000, "standard").otherwise("premium")
    return (
        table(spark, sf_dir, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), tier.alias("tier"))
        .agg(
            F.sum("n").alias("orders"),
            (_double(F.sum("spent")) / F.sum("n")).alias("avg_value"),
            (_double(F.sum("age")) / F.sum("n")).alias("avg_age_days"),
        )
    )


def channel_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = {name: F.col(name).cast("decimal(4,2)") for name in ("l_discount", "l_tax")}
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("n"),
            F.sum(_money("l_quantity")).alias("units"),
            F.sum(_revenue()).alias("revenue"),
            F.sum(_revenue() * rate["l_discount"]).alias("discount"),
            F.sum(_revenue() * rate["l_tax"]).alias("tax"),
        )
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("channel"))
    return (
        table(spark, sf_dir, "supplier")
        .join(per_supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("channel")
        .agg(
            F.sum("n").alias("lines"),
            *(_double(F.sum(c)).alias(c) for c in ("units", "revenue", "discount", "tax")),
        )
    )


def device_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with their latest orders, ties kept. The latest time is a map-side combined maximum, so a
    customer with very many orders is never sorted or gathered in one task."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    latest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_acctbal")
        .join(orders.join(latest, ["o_custkey", "o_orderdate"]), F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_orderdate", "o_totalprice")
    )


def active_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rank = F.array_position(F.array(*(F.lit(p) for p in PRIORITY_ORDER)), F.col("o_orderpriority"))
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'O'")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_name", "o_orderpriority", rank.cast("int").alias("priority_rank"), "o_orderdate")
        .orderBy("priority_rank", "o_orderkey")
    )


SEED_VIEWS = {
    "v01_active_customers": active_customers,
    "v02_order_summary": order_summary,
    "v03_product_stats": product_stats,
    "v04_revenue_by_category": revenue_by_category,
    "v05_daily_active_users": daily_active_users,
    "v06_error_summary": error_summary,
    "v07_headcount_by_department": headcount_by_department,
    "v08_active_positions": active_positions,
    "v09_monthly_sales": monthly_sales,
    "v10_product_performance": product_performance,
    "v11_customer_segments": customer_segments,
    "v12_channel_attribution": channel_attribution,
    "v13_device_health": device_health,
    "v14_active_alerts": active_alerts,
}
