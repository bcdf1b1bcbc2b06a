"""Adapter from the driver's Parquet tables to the retail star schema.

Mapping (identical in the DuckDB oracle):

sales      transaction_id = l_orderkey, customer_id = o_custkey (lineitem
           left-joined to orders on the order key), product_id = l_partkey,
           store_id = 'S' || (l_suppkey % 10), quantity = l_quantity as INT if whole,
           price = l_extendedprice as DECIMAL(12,2), timestamp = o_orderdate
customers  customer_id = c_custkey, name = c_name, city = nation name (left
           join, so a customer with an unknown nation keeps a NULL city),
           segment = c_mktsegment
products   product_id = p_partkey, category = p_type, brand = p_brand
events     event_time = ts, product_id = event_type, quantity = props.k,
           price = value, transaction_id = event_id, customer_id = user_id

Only the columns each frame needs are selected, so the Parquet scans read a
pruned schema; the lineitem/orders join is left to the planner (broadcast
when orders is small, sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ledgerline.params import RetailParams
from ledgerline.schemas import MONEY


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Declared schemas of the driver tables this adapter reads. Reading with a
# declared schema skips the footer-inference job that a bare
# ``spark.read.parquet`` launches for every table.
DRIVER_SCHEMAS = {
    "lineitem": _schema(
        ("l_orderkey", LongType()),
        ("l_partkey", LongType()),
        ("l_suppkey", LongType()),
        ("l_linenumber", IntegerType()),
        ("l_quantity", DoubleType()),
        ("l_extendedprice", DoubleType()),
        ("l_discount", DoubleType()),
        ("l_tax", DoubleType()),
        ("l_returnflag", StringType()),
        ("l_linestatus", StringType()),
        ("l_shipdate", TimestampNTZType()),
    ),
    "orders": _schema(
        ("o_orderkey", LongType()),
        ("o_custkey", LongType()),
        ("o_orderstatus", StringType()),
        ("o_totalprice", DoubleType()),
        ("o_orderdate", TimestampNTZType()),
        ("o_orderpriority", StringType()),
    ),
    "customer": _schema(
        ("c_custkey", LongType()),
        ("c_name", StringType()),
        ("c_nationkey", IntegerType()),
        ("c_acctbal", DoubleType()),
        ("c_mktsegment", StringType()),
    ),
    "nation": _schema(
        ("n_nationkey", IntegerType()), ("n_name", StringType()), ("n_regionkey", IntegerType())
    ),
    "part": _schema(
        ("p_partkey", LongType()),
        ("p_name", StringType()),
        ("p_brand", StringType()),
        ("p_type", StringType()),
        ("p_size", IntegerType()),
        ("p_retailprice", DoubleType()),
    ),
    "events": _schema(
        ("event_id", LongType()),
        ("ts", TimestampNTZType()),
        ("user_id", LongType()),
        ("event_type", StringType()),
        ("value", DoubleType()),
        ("props", StringType()),
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its files are listed anew, so an overwritten table is seen."""
    schema = DRIVER_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Left: a line without its order stays and is rejected for its missing customer.
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "left")
    whole = F.col("l_quantity") == F.floor("l_quantity")
    return joined.select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("store_id"),
        # What does not fit the type (or is no whole number) is null, and so rejected.
        F.when(whole, F.col("l_quantity").try_cast("int")).alias("quantity"),
        F.col("l_extendedprice").try_cast(MONEY).alias("price"),
        F.col("o_orderdate").alias("timestamp"),
    )


def customers_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )


def products_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )


EVENTS_SCHEMA = DRIVER_SCHEMAS["events"]


def _events_as_sales(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.lit(None).cast("string").alias("store_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("quantity"),
        F.col("value").try_cast(MONEY).alias("price"),
        # A watermark needs TIMESTAMP (not TIMESTAMP_NTZ).
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def events_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch read of ``events`` shaped like a sales stream."""
    return _events_as_sales(read_table(spark, sf_dir, "events"))


def events_stream_from_tables(
    spark: SparkSession, sf_dir: str, max_bytes_per_trigger: int = RetailParams.max_bytes_per_trigger
) -> DataFrame:
    """Streaming read of ``events`` (the directory, filtered to that file or folder)."""
    stream = (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(sf_dir)
    )
    return _events_as_sales(stream)


def events_stream_from_folder(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a folder to which Parquet files of ``events`` rows are added."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _events_as_sales(reader.parquet(folder))


def event_halves(events: DataFrame) -> tuple[Column, Column]:
    """(micros of an event's time, the middle of the span of all events in micros or null)."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    lo, hi = events.agg(F.min(micros), F.max(micros)).first()
    middle = None if lo is None else (lo + hi) // 2
    return micros, F.lit(middle).cast("long")
