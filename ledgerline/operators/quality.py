"""Cleaning, rejection and validation rules.

One cleaning rule feeds every downstream operator, batch and stream alike:
a sales row is valid when its three ids, price and quantity are present and
``price > price_floor and quantity > quantity_floor``. ``clean_sales`` keeps
exactly the valid rows and ``rejected_rows`` reports exactly the others, so
clean + rejected = input. The rule is stateless, hence streaming-safe.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import revenue
from ledgerline.functions.timecols import parse_timestamp
from ledgerline.params import RetailParams
from ledgerline.schemas import CORRUPT_RECORD, FACT_COLUMNS, SALES_KEYS, SALES_NUMBERS

# Fixed reject reasons, in precedence order.
REASON_MALFORMED = "malformed"
REASON_NULL_KEY = "null_key"
REASON_NULL_NUMBER = "null_number"
REASON_NON_POSITIVE = "non_positive"
REASONS = (REASON_MALFORMED, REASON_NULL_KEY, REASON_NULL_NUMBER, REASON_NON_POSITIVE)


def _any_null(cols: Iterable[str]) -> Column:
    out = None
    for c in cols:
        cond = F.col(c).isNull()
        out = cond if out is None else (out | cond)
    return out


def _in_range(params: RetailParams) -> Column:
    return (F.col("price") > F.lit(params.price_floor)) & (
        F.col("quantity") > F.lit(params.quantity_floor)
    )


def is_valid_sale(params: RetailParams = RetailParams()) -> Column:
    """TRUE exactly for rows that ``clean_sales`` keeps (never NULL)."""
    return ~_any_null(SALES_KEYS + SALES_NUMBERS) & F.coalesce(_in_range(params), F.lit(False))


def clean_sales(raw: DataFrame, params: RetailParams = RetailParams()) -> DataFrame:
    """Parse the timestamp, add ``revenue``, keep valid rows (F3 + F4).

    Output columns: transaction_id, customer_id, product_id, store_id,
    quantity, price, revenue, timestamp.
    """
    kept = raw.filter(is_valid_sale(params))
    cols = {c: F.col(c) for c in FACT_COLUMNS if c in raw.columns}
    cols["timestamp"] = parse_timestamp(raw, "timestamp")
    cols["revenue"] = revenue()
    return kept.select(*[cols[c].alias(c) for c in FACT_COLUMNS])


def reject_reason(raw: DataFrame, params: RetailParams = RetailParams()) -> Column:
    """Reason a row is rejected (NULL for a valid row)."""
    invalid = ~is_valid_sale(params)
    reason = F.when(~invalid, F.lit(None).cast("string"))
    if CORRUPT_RECORD in raw.columns:
        reason = reason.when(F.col(CORRUPT_RECORD).isNotNull(), F.lit(REASON_MALFORMED))
    return (
        reason.when(_any_null(SALES_KEYS), F.lit(REASON_NULL_KEY))
        .when(_any_null(SALES_NUMBERS), F.lit(REASON_NULL_NUMBER))
        .otherwise(F.lit(REASON_NON_POSITIVE))
    )


def rejected_records(raw: DataFrame, params: RetailParams = RetailParams()) -> DataFrame:
    """Every rejected row with its reason (raw columns kept for audit)."""
    return raw.withColumn("reason", reject_reason(raw, params)).filter(F.col("reason").isNotNull())


def rejected_rows(raw: DataFrame, params: RetailParams = RetailParams()) -> DataFrame:
    """Count of rejected rows per reason: (reason, n).

    A single aggregation (partial + final) instead of counting the input and
    the output in two separate jobs.
    """
    return (
        rejected_records(raw, params)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def require_columns(df: DataFrame, label: str, required: Sequence[str]) -> None:
    """Raise ``ValueError`` when a required column is missing (no job runs)."""
    absent = sorted(set(required).difference(df.columns))
    if absent:
        raise ValueError(f"{label}: no column named {', '.join(absent)}")


def require_rows(df: DataFrame, label: str) -> None:
    """Raise ``ValueError`` when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{label} has no rows")


def check_frame(df: DataFrame, label: str, required: Sequence[str]) -> None:
    require_columns(df, label, required)
    require_rows(df, label)


def dimension(df: DataFrame, key: str) -> DataFrame:
    """A dimension with its key present (rows with a NULL key dropped)."""
    return df.dropna(subset=[key])


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys with no row in the dimension: (key, n_sales).

    The fact is counted per key first (map-side combine), so the anti join sees
    one row per key and a hot key costs no more than any other.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_sales"))
    return per_key.join(dim.select(key), on=key, how="left_anti")


def duplicate_keys(dim: DataFrame, *key: str) -> DataFrame:
    """Keys (of one or several columns) present more than once: (key..., n)."""
    return (
        dim.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def table_profile(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: (table_name, n_rows, n_null_keys).

    Each table is one distributed global aggregate; the one-row results are
    unioned.
    """
    parts = []
    for name, (df, keys) in tables.items():
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(_any_null(keys)).alias("n_null_keys"),
            ).select(F.lit(name).alias("table_name"), "n_rows", "n_null_keys")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
