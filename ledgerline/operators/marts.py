"""Revenue marts: the business questions of the batch job.

Inputs are cleaned sales (``clean_sales``), customers and products. Joins
are written declaratively: the planner broadcasts a dimension only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-checks with measured sizes), otherwise it uses a sort-merge join whose hot
keys AQE splits. Aggregations are partial + final, so a hot group is combined
map-side before any shuffle.

Money stays DECIMAL inside; ``money_out`` turns totals into DOUBLE at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.money import avg_money, money_out, revenue
from ledgerline.functions.timecols import calendar_date, month_label
from ledgerline.schemas import ENRICHED_COLUMNS


# ---------------------------------------------------------------- joins

def enrich(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Star join sales x customers x products (inner, as in the original).

    Sales whose customer or product is unknown are dropped here; they are
    reported by ``orphan_keys`` and still counted by the fact-level measures.
    ``revenue`` is rounded to 2 dp per row; on 2-dp decimal prices that is a
    no-op, decided from the schema, so no per-row work is planned for it. It
    follows from the price and the quantity and is not shuffled, and the
    products, whose attributes are the shorter ones, are joined first.
    """
    c = customers.select(
        "customer_id", F.col("name").alias("customer_name"), "city", "segment"
    )
    p = products.select("product_id", "category", "brand")
    joined = sales.drop("revenue").join(p, "product_id", "inner").join(c, "customer_id", "inner")
    joined = joined.withColumn("revenue", revenue())
    rev_type = joined.schema["revenue"].dataType
    if not (isinstance(rev_type, DecimalType) and rev_type.scale <= 2):
        joined = joined.withColumn("revenue", F.round("revenue", 2))
    return joined.select(*ENRICHED_COLUMNS)


# ---------------------------------------------------------------- fact-only

def product_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per product: (product_id, revenue DECIMAL)."""
    return sales.groupBy("product_id").agg(F.sum("revenue").alias("revenue"))


def top_products(sales: DataFrame, k: int) -> DataFrame:
    """Top-k products by revenue, product_id as tie-break.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its
    own k best rows and only k x partitions rows are merged.
    """
    return product_revenue(sales).orderBy(F.desc("revenue"), F.asc("product_id")).limit(k)


def high_value_sales(sales: DataFrame, threshold) -> DataFrame:
    """Rows with revenue at or above ``threshold`` (inclusive)."""
    return sales.filter(F.col("revenue") >= F.lit(threshold))


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Monthly revenue over all clean sales, NULL timestamps excluded.

    (month, monthly_revenue DECIMAL, num_transactions)
    """
    return (
        sales.filter(F.col("timestamp").isNotNull())
        .groupBy(month_label("timestamp").alias("month"))
        .agg(
            F.sum("revenue").alias("monthly_revenue"),
            F.count("transaction_id").alias("num_transactions"),
        )
    )


# ---------------------------------------------------------------- one dimension

def revenue_by_city(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """(city, total_revenue DECIMAL, total_transactions) over sales x customers."""
    per_customer = sales.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.count("transaction_id").alias("n")
    )
    joined = per_customer.join(customers.select("customer_id", "city"), "customer_id", "inner")
    return joined.groupBy("city").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("n").alias("total_transactions")
    )


def top_products_with_attributes(sales: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """Top-k (product_id, category, brand, total_revenue) over sales x products.

    Revenue is summed per product before the join: the grouping key contains
    the join key, so this is exact (duplicate product rows still fan out) and
    the join sees one row per product instead of one per sale.
    """
    per_product = sales.groupBy("product_id").agg(F.sum("revenue").alias("total_revenue"))
    joined = per_product.join(
        products.select("product_id", "category", "brand"), "product_id", "inner"
    )
    return (
        joined.groupBy("product_id", "category", "brand")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), F.asc("product_id"), F.asc("category"), F.asc("brand"))
        .limit(k)
    )


# ---------------------------------------------------------------- gold marts (enriched)

def gold_revenue_by_city(enriched: DataFrame) -> DataFrame:
    """(city, total_revenue, total_transactions, avg_order_value = mean line revenue)."""
    return enriched.groupBy("city").agg(
        money_out(F.sum("revenue")).alias("total_revenue"),
        F.count("transaction_id").alias("total_transactions"),
        avg_money(F.sum("revenue"), F.count("revenue")).alias("avg_order_value"),
    )


def gold_revenue_by_category(enriched: DataFrame) -> DataFrame:
    """(category, brand, total_revenue, total_units_sold)."""
    return enriched.groupBy("category", "brand").agg(
        money_out(F.sum("revenue")).alias("total_revenue"),
        F.sum("quantity").cast("bigint").alias("total_units_sold"),
    )


def gold_customer_segments(enriched: DataFrame) -> DataFrame:
    """(segment, total_revenue, unique_customers (exact), avg_spend)."""
    return enriched.groupBy("segment").agg(
        money_out(F.sum("revenue")).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
        avg_money(F.sum("revenue"), F.count("revenue")).alias("avg_spend"),
    )


def gold_monthly_trend(enriched: DataFrame) -> DataFrame:
    """(month, monthly_revenue, num_transactions); a NULL month is kept."""
    return (
        enriched.groupBy(month_label("timestamp").alias("month"))
        .agg(
            money_out(F.sum("revenue")).alias("monthly_revenue"),
            F.count("transaction_id").alias("num_transactions"),
        )
    )


def daily_revenue(enriched: DataFrame) -> DataFrame:
    """(date, daily_revenue DECIMAL); a NULL date is kept."""
    return enriched.groupBy(calendar_date("timestamp").alias("date")).agg(
        F.sum("revenue").alias("daily_revenue")
    )


def low_sales_days(
    daily: DataFrame,
    threshold,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Days whose revenue is below ``threshold`` (strict): (date, daily_revenue).

    By default only days with sales can alert (as in the original). Pass a
    ``calendar`` (one ``date`` column, e.g. from ``star.dim_date``) to make
    days without any sale alert with revenue 0.
    """
    if calendar is not None:
        daily = calendar.select("date").join(daily, "date", "left").select(
            "date", F.coalesce("daily_revenue", F.lit(0).cast("decimal(33,2)")).alias("daily_revenue")
        )
    return daily.filter(F.col("daily_revenue") < F.lit(threshold))


def with_money_out(df: DataFrame, *cols: str) -> DataFrame:
    """Replace DECIMAL money columns by rounded DOUBLEs for output."""
    for c in cols:
        df = df.withColumn(c, money_out(c))
    return df


__all__ = [
    "enrich",
    "product_revenue",
    "top_products",
    "high_value_sales",
    "monthly_trend",
    "revenue_by_city",
    "top_products_with_attributes",
    "gold_revenue_by_city",
    "gold_revenue_by_category",
    "gold_customer_segments",
    "gold_monthly_trend",
    "daily_revenue",
    "low_sales_days",
    "with_money_out",
]
