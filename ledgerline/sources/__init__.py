"""Readers: CSV with explicit schemas, Parquet tables, streaming sources."""

from ledgerline.sources.csv import (
    read_customers_csv,
    read_products_csv,
    read_raw_csv,
    read_sales_csv,
    sales_csv_stream,
)
from ledgerline.sources.tables import (
    customers_from_tables,
    events_from_tables,
    events_stream_from_tables,
    products_from_tables,
    read_table,
    sales_from_tables,
)

__all__ = [
    "read_customers_csv",
    "read_products_csv",
    "read_raw_csv",
    "read_sales_csv",
    "sales_csv_stream",
    "customers_from_tables",
    "events_from_tables",
    "events_stream_from_tables",
    "products_from_tables",
    "read_table",
    "sales_from_tables",
]
