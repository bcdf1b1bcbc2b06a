"""Dashboard visuals: one DataFrame per visual (measure x axis).

Pages of the original dashboard layout:

- Executive Overview      KPI cards Total Sales, Average Order Value,
                          Sales Growth %, Customer Count  -> executive_overview
- Sales by Geography      map and bar chart of Total Sales by city -> sales_by_city
- Sales Trend             Total Sales and Sales Growth % by month -> sales_trend
- Top Products            Total Sales by brand / by category
                          -> sales_by_brand, sales_by_category
- Customer Segmentation   donut and table by segment -> segment_summary
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import avg_money, money_out
from ledgerline.operators.measures import sales_by, sales_growth_by_month, sales_growth_mtd


def executive_overview(fact: DataFrame) -> DataFrame:
    """One row: total_sales, average_order_value, sales_growth, customer_count.

    The distinct counts are counts of per-transaction and per-customer
    aggregates (scalar subqueries), so no row is expanded once per distinct
    count; the growth card needs one row per day only.
    """
    def members(column: str):
        keys = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("one"))
        return keys.agg(F.count("one").alias("n")).scalar()

    total = fact.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("total"))
    cards = total.select(
        "total", members("transaction_id").alias("n_txn"), members("customer_id").alias("customer_count")
    )
    growth = sales_growth_mtd(fact).select("growth").scalar()
    return cards.select(
        money_out("total").alias("total_sales"),
        F.coalesce(avg_money("total", "n_txn"), F.lit(0.0)).alias("average_order_value"),
        growth.alias("sales_growth"),
        "customer_count",
    )


def sales_by_city(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return sales_by(fact, customers, "customer_id", "city")


def sales_by_brand(fact: DataFrame, products: DataFrame) -> DataFrame:
    return sales_by(fact, products, "product_id", "brand")


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    return sales_by(fact, products, "product_id", "category")


def sales_trend(fact: DataFrame) -> DataFrame:
    """(month, total_sales, sales_growth): line and area charts of the trend page."""
    return sales_growth_by_month(fact).select(
        "month",
        F.col("revenue").alias("total_sales"),
        F.col("growth").alias("sales_growth"),
    )


def segment_summary(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """(segment, total_sales, average_order_value, customer_count).

    Lines are first summed per (transaction, customer), so the fact is shuffled
    once and the dimension join sees one row per transaction. Grouping sets give
    one row per transaction and one per customer of a segment, with the other id
    null, so counting the ids counts each member once.
    """
    per_txn = fact.groupBy("transaction_id", "customer_id").agg(F.sum("revenue").alias("revenue"))
    joined = per_txn.join(customers.select("customer_id", "segment"), "customer_id", "left")
    keys = [F.col(c) for c in ("segment", "transaction_id", "customer_id")]
    segment, transaction, customer = keys
    members = joined.groupingSets([[segment, transaction], [segment, customer]], *keys).agg(
        F.sum("revenue").alias("revenue"), F.grouping("customer_id").alias("is_transaction")
    )
    sums = members.groupBy("segment").agg(
        F.sum(F.when(F.col("is_transaction") == 1, F.col("revenue"))).alias("total"),
        F.count("transaction_id").alias("n_txn"),
        F.count("customer_id").alias("customer_count"),
    )
    return sums.select(
        "segment",
        money_out("total").alias("total_sales"),
        F.coalesce(avg_money("total", "n_txn"), F.lit(0.0)).alias("average_order_value"),
        "customer_count",
    )


def dashboard(fact: DataFrame, customers: DataFrame, products: DataFrame) -> dict:
    """Every visual of the dashboard as a lazy DataFrame: {page: {visual: DataFrame}}.

    Visuals on one page that show the same data share one DataFrame (the map
    and the bar chart of the geography page; both segmentation visuals read
    the segment summary).
    """
    by_city = sales_by_city(fact, customers)
    trend = sales_trend(fact)
    segments = segment_summary(fact, customers)
    return {
        "Executive Overview": {"KPI Cards": executive_overview(fact)},
        "Sales by Geography": {"Filled Map": by_city, "Bar Chart": by_city},
        "Sales Trend": {
            "Line Chart": trend.select("month", "total_sales"),
            "Area Chart": trend.select("month", "sales_growth"),
        },
        "Top Products": {
            "Bar Chart": sales_by_brand(fact, products),
            "Treemap": sales_by_category(fact, products),
        },
        "Customer Segmentation": {
            "Donut Chart": segments.select("segment", "total_sales"),
            "Table": segments,
        },
    }
