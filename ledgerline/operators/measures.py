"""BI measures, evaluated (the original only stored them as formula text).

Fixed readings of the measure definitions:

- Total Sales          sum(price * quantity) over the fact
- Average Order Value  Total Sales / distinct transaction_id, 0 when none
- Sales Growth %       month-to-date vs the same span one month back, 0 when
                       there is no base (KPI form); whole calendar month vs the
                       preceding calendar month (month-axis form)
- Top Category         category with the highest Total Sales, ties to the
                       alphabetically first
- Customer Count       distinct customer_id over the fact
- Revenue by Segment   Total Sales with every Customer filter removed except
                       segment (ALLEXCEPT)

Fact-level measures use the fact alone, so sales with an unknown customer or
product still count. Measures sliced by a dimension attribute use a left join
and the unknown member is one NULL group.

Global values are combined through scalar subqueries (``DataFrame.scalar``),
never through a driver ``collect`` or a cross join, and windows only run over
already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.money import avg_money, money_out, safe_growth
from ledgerline.functions.timecols import calendar_date, month_start


def sales_by(fact: DataFrame, dim: DataFrame, key: str, axis: str) -> DataFrame:
    """Total Sales per dimension attribute: (axis, total_sales DOUBLE)."""
    per_key = fact.groupBy(key).agg(F.sum("revenue").alias("revenue"))
    joined = per_key.join(dim.select(key, axis), key, "left")
    return joined.groupBy(axis).agg(money_out(F.sum("revenue")).alias("total_sales"))


def total_sales(fact: DataFrame) -> DataFrame:
    return fact.agg(money_out(F.coalesce(F.sum("revenue"), F.lit(0))).alias("total_sales"))


def _aov(total, n_transactions):
    return F.coalesce(avg_money(total, n_transactions), F.lit(0.0))


def average_order_value(fact: DataFrame) -> DataFrame:
    return fact.agg(
        _aov(F.sum("revenue"), F.countDistinct("transaction_id")).alias("average_order_value")
    )


def customer_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("customer_id").alias("customer_count"))


def top_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """(top_category): the category with the highest Total Sales."""
    per_product = fact.groupBy("product_id").agg(F.sum("revenue").alias("revenue"))
    by_cat = per_product.join(
        products.select("product_id", "category"), "product_id", "left"
    )
    return (
        by_cat.groupBy("category")
        .agg(F.sum("revenue").alias("rev"))
        .orderBy(F.desc("rev"), F.asc_nulls_last("category"))
        .limit(1)
        .select(F.col("category").alias("top_category"))
    )


def sales_growth_mtd(fact: DataFrame) -> DataFrame:
    """KPI form of Sales Growth %: (this_month, last_month, growth).

    d = latest sale date; this month = [first of d's month, d]; last month =
    [first of the previous month, d - 1 month]. The fact is aggregated once per
    day; the days (as many as the calendar has) are gathered into one row, which
    gives the latest date and both sums, so the fact is scanned once.
    """
    daily = fact.groupBy(calendar_date("timestamp").alias("d")).agg(
        F.sum("revenue").alias("revenue")
    )
    days = daily.agg(
        F.max("d").alias("last_day"), F.collect_list(F.struct("d", "revenue")).alias("days")
    ).withColumn("prev_day", F.add_months("last_day", -1))

    def total(day: str):
        inside = F.filter("days", lambda x: x["d"].between(F.trunc(day, "MM"), F.col(day)))
        zero = F.lit(0).cast("decimal(38,2)")
        return F.aggregate(inside, zero, lambda a, x: (a + x["revenue"]).cast("decimal(38,2)"))

    sums = days.select(total("last_day").alias("this_sum"), total("prev_day").alias("last_sum"))
    return sums.select(
        money_out("this_sum").alias("this_month"),
        money_out("last_sum").alias("last_month"),
        safe_growth("this_sum", "last_sum").alias("growth"),
    )


def growth_by_day(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales Growth % on a day axis: (date, revenue, mtd, last_mtd, growth).

    ``calendar``: every day as ``date``; a day without sales has revenue 0. ``mtd`` runs
    from the first of the month up to the day, ``last_mtd`` is the same up to the
    day one month before (0 where the calendar has none). The running sum is
    a range window over the days of one month.
    """
    daily = fact.groupBy(calendar_date("timestamp").alias("date")).agg(F.sum("revenue").alias("revenue"))
    zero = F.lit(0).cast("decimal(33,2)")
    days = calendar.select("date").join(daily, "date", "left").select("date", F.coalesce("revenue", zero).alias("revenue"))
    so_far = (
        Window.partitionBy(F.trunc("date", "MM"))
        .orderBy("date")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = days.withColumn("mtd", F.sum("revenue").over(so_far))
    before = running.select(F.col("date").alias("prev_date"), F.col("mtd").alias("prev_mtd"))
    joined = running.join(before, F.add_months("date", -1) == F.col("prev_date"), "left")
    last = F.coalesce("prev_mtd", F.lit(0).cast("decimal(38,2)"))
    return joined.withColumn("last", last).select(
        "date",
        money_out("revenue").alias("revenue"),
        money_out("mtd").alias("mtd"),
        money_out("last").alias("last_mtd"),
        safe_growth("mtd", "last").alias("growth"),
    )


def monthly_totals(fact: DataFrame) -> DataFrame:
    """(month_start DATE, revenue DECIMAL) for rows with a timestamp."""
    return (
        fact.filter(F.col("timestamp").isNotNull())
        .groupBy(month_start("timestamp").alias("month_start"))
        .agg(F.sum("revenue").alias("revenue"))
    )


def sales_growth_by_month(fact: DataFrame) -> DataFrame:
    """Month-axis form of Sales Growth %: (month, revenue, growth).

    Each month is compared with the preceding calendar month (growth 0 when
    that month has no sales). The comparison is an equi-join of the monthly
    aggregate with itself shifted by one month: no global window, and both
    sides hold one row per month.
    """
    months = monthly_totals(fact)
    previous = months.select(
        F.add_months("month_start", 1).alias("month_start"), F.col("revenue").alias("prev_revenue")
    )
    joined = months.join(previous, "month_start", "left")
    return joined.select(
        F.date_format("month_start", "yyyy-MM").alias("month"),
        money_out("revenue").alias("revenue"),
        safe_growth("revenue", "prev_revenue").alias("growth"),
    )


def revenue_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """(city, segment, revenue, segment_revenue) on a city x segment axis.

    ``segment_revenue`` repeats the segment's total whatever the city, as
    ALLEXCEPT(Customer, segment) does. It is a window sum over the aggregated
    (city, segment) rows, partitioned by segment.
    """
    per_customer = fact.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
    joined = per_customer.join(
        customers.select("customer_id", "city", "segment"), "customer_id", "left"
    )
    cells = joined.groupBy("city", "segment").agg(F.sum("revenue").alias("rev"))
    seg = F.sum("rev").over(Window.partitionBy("segment"))
    return cells.select(
        "city",
        "segment",
        money_out("rev").alias("revenue"),
        money_out(seg).alias("segment_revenue"),
    )


__all__ = [
    "sales_by",
    "total_sales",
    "average_order_value",
    "customer_count",
    "top_category",
    "sales_growth_mtd",
    "monthly_totals",
    "sales_growth_by_month",
    "revenue_by_segment",
]
