"""CSV sources for the retail files (sales, customers, products).

All readers use a declared schema (no inference) and:

- ``enforceSchema=false``: the header is checked against the schema, so a
  file whose columns are reordered fails instead of silently shifting values;
- leading/trailing whitespace is trimmed from every field;
- PERMISSIVE mode with a corrupt-record column: a failed cast becomes NULL and
  the raw line is kept for the reject report. Casts are only attempted for the
  columns a query reads, so a bad value in an unread column is not flagged;
  the reject report reads every column its rule uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.params import RetailParams
from ledgerline.schemas import (
    CORRUPT_RECORD,
    CUSTOMER_SCHEMA,
    PRODUCT_SCHEMA,
    SALES_SCHEMA,
)


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT_RECORD, StringType(), True)])


def _reader(spark: SparkSession, schema: StructType, keep_corrupt: bool):
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
    )
    if keep_corrupt:
        # Tokenize every field even when a query selects only some, so a
        # short or long line is flagged whatever the projection.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD).option(
            "columnPruning", False
        )
        schema = _with_corrupt(schema)
    return reader.schema(schema)


def read_sales_csv(spark: SparkSession, path: str, keep_corrupt: bool = True) -> DataFrame:
    return _reader(spark, SALES_SCHEMA, keep_corrupt).csv(path)


def read_customers_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return _reader(spark, CUSTOMER_SCHEMA, keep_corrupt).csv(path)


def read_products_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return _reader(spark, PRODUCT_SCHEMA, keep_corrupt).csv(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Untyped landing read for bronze: every column a string, as it arrived."""
    return spark.read.option("header", True).csv(path)


def sales_csv_stream(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int = RetailParams.max_bytes_per_trigger,
) -> DataFrame:
    """Streaming source over a directory of sales CSV files (header checked)."""
    rate = ("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_files_per_trigger is not None:
        rate = ("maxFilesPerTrigger", max_files_per_trigger)
    return (
        spark.readStream.option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option(*rate)
        .schema(SALES_SCHEMA)
        .csv(directory)
    )
