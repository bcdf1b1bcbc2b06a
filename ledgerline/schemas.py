"""Explicit schemas for the retail sources.

Money is exact: ``DECIMAL(12,2)`` instead of the 32-bit float of the original
application (a float turns 10.10 into 10.100000381 and makes engine sums
disagree).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(12, 2)
CORRUPT_RECORD = "_corrupt_record"

SALES_KEYS = ("transaction_id", "customer_id", "product_id")
SALES_NUMBERS = ("price", "quantity")

SALES_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("customer_id", StringType(), False),
        StructField("product_id", StringType(), False),
        StructField("store_id", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("price", MONEY, True),
        StructField("timestamp", StringType(), True),
    ]
)

CUSTOMER_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), False),
        StructField("name", StringType(), True),
        StructField("city", StringType(), True),
        StructField("segment", StringType(), True),
    ]
)

PRODUCT_SCHEMA = StructType(
    [
        StructField("product_id", StringType(), False),
        StructField("category", StringType(), True),
        StructField("brand", StringType(), True),
    ]
)

# Column order of cleaned sales / the gold fact table.
FACT_COLUMNS = (
    "transaction_id",
    "customer_id",
    "product_id",
    "store_id",
    "quantity",
    "price",
    "revenue",
    "timestamp",
)

# Column order of the enriched (sales x customers x products) table.
ENRICHED_COLUMNS = (
    "transaction_id",
    "timestamp",
    "quantity",
    "price",
    "revenue",
    "customer_id",
    "customer_name",
    "city",
    "segment",
    "product_id",
    "category",
    "brand",
)


def silver_sales_schema(timestamp_type=None) -> StructType:
    """Schema used to read silver sales back.

    ``store_id`` is declared as a string so that partition values such as
    ``01`` are not re-inferred as the integer 1.
    """
    ts = timestamp_type if timestamp_type is not None else TimestampType()
    return StructType(
        [
            StructField("transaction_id", StringType(), True),
            StructField("customer_id", StringType(), True),
            StructField("product_id", StringType(), True),
            StructField("quantity", IntegerType(), True),
            StructField("price", MONEY, True),
            StructField("revenue", DecimalType(23, 2), True),
            StructField("timestamp", ts, True),
            StructField("store_id", StringType(), True),
        ]
    )


# Parquet compression of the stored layers.
LAYER_CODEC = "zstd"

# Columns of the stored layers, so that reading one back plans nothing else.
LAYER_SCHEMAS = {
    "silver/customers": "customer_id string, name string, city string, segment string",
    "silver/products": "product_id string, category string, brand string",
    "gold/fact_sales": (
        "transaction_id string, customer_id string, product_id string, store_id string, quantity int, "
        "price decimal(12,2), revenue decimal(23,2), timestamp timestamp_ntz"
    ),
    "gold/enriched_sales": (
        "transaction_id string, timestamp timestamp_ntz, quantity int, price decimal(12,2), "
        "revenue decimal(23,2), customer_id string, customer_name string, city string, segment string, "
        "product_id string, category string, brand string"
    ),
    "gold/revenue_by_city": "city string, total_revenue double, total_transactions bigint, avg_order_value double",
    "gold/revenue_by_category": "category string, brand string, total_revenue double, total_units_sold bigint",
    "gold/customer_segments": "segment string, total_revenue double, unique_customers bigint, avg_spend double",
    "gold/monthly_trend": "month string, monthly_revenue double, num_transactions bigint",
    "events/typed": (
        "transaction_id string, customer_id string, product_id string, store_id string, quantity int, "
        "price decimal(12,2), timestamp timestamp"
    ),
}
