"""Session temp views for Spark SQL over the cleaned retail frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_retail_views(
    spark: SparkSession, sales: DataFrame, customers: DataFrame, products: DataFrame
) -> None:
    """Publish the three frames as session temp views (lazy, no data copied)."""
    sales.createOrReplaceTempView("sales")
    customers.createOrReplaceTempView("customers")
    products.createOrReplaceTempView("products")
