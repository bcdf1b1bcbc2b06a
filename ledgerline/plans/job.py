"""Batch job over the three retail CSV files.

Runs what the original application's batch phases did, as one function:
read with declared schemas, check the frames, clean, land bronze, write
silver and gold, and evaluate the low-sales alert; every result is also
available as a lazy DataFrame through ``ledgerline.operators``.

    python -m ledgerline.plans.job --sales S.csv --customers C.csv \
        --products P.csv --out ROOT

No Spark settings are fixed here beyond what the caller's session has.
"""

from __future__ import annotations

import argparse
import json
from decimal import Decimal
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import quality, star
from ledgerline.params import RetailParams
from ledgerline.plans import lakehouse
from ledgerline.sources import (
    read_customers_csv,
    read_products_csv,
    read_raw_csv,
    read_sales_csv,
)


@dataclass
class JobReport:
    bronze: dict = field(default_factory=dict)
    silver: dict = field(default_factory=dict)
    gold: dict = field(default_factory=dict)
    rejected: dict = field(default_factory=dict)
    orphans: dict = field(default_factory=dict)
    duplicate_keys: dict = field(default_factory=dict)
    low_sales_days: int = 0


def _as_dict(counts: DataFrame) -> dict[str, int]:
    """(name, n) rows, a handful of them, as a dict."""
    pairs = F.collect_list(F.struct(*counts.columns))
    return dict(counts.agg(F.map_from_entries(pairs)).first()[0])


def run_batch_job(
    spark: SparkSession,
    sales_path: str,
    customers_path: str,
    products_path: str,
    out_root: str,
    params: RetailParams = RetailParams(),
) -> JobReport:
    sales_raw = read_sales_csv(spark, sales_path)
    customers = read_customers_csv(spark, customers_path)
    products = read_products_csv(spark, products_path)
    quality.check_frame(sales_raw, "sales", ["transaction_id", "price", "quantity"])
    quality.check_frame(customers, "customers", ["customer_id", "city", "segment"])
    quality.check_frame(products, "products", ["product_id", "category", "brand"])

    report = JobReport()
    report.bronze = lakehouse.land_bronze(
        spark,
        {
            "sales": read_raw_csv(spark, sales_path),
            "customers": read_raw_csv(spark, customers_path),
            "products": read_raw_csv(spark, products_path),
        },
        out_root,
    )
    # Rejects are a table of their own; both counts are those of committed files.
    lakehouse.write_silver_sales(quality.clean_sales(sales_raw, params), out_root)
    lakehouse.write_rejects(sales_raw, out_root, params)
    audit = _as_dict(lakehouse.sales_audit(spark, out_root))
    report.rejected = {k.split(":")[1]: n for k, n in audit.items() if k.startswith("rejected:")}
    report.silver = {"sales": audit["silver"], **lakehouse.write_silver_dims(customers, products, out_root)}

    # Downstream layers read the written silver tables, not the CSV plans.
    silver_sales = lakehouse.read_silver_sales(spark, out_root)
    silver_customers = spark.read.parquet(f"{out_root}/silver/customers")
    silver_products = spark.read.parquet(f"{out_root}/silver/products")
    report.gold = lakehouse.write_gold(silver_sales, silver_customers, silver_products, out_root)

    checks = star.relationship_counts(silver_sales, silver_customers, silver_products)
    found = _as_dict(checks)
    report.orphans = {k: found[k] for k in ("orphan_customers", "orphan_products")}
    report.duplicate_keys = {k: found[k] for k in ("duplicate_customers", "duplicate_products")}
    report.low_sales_days = lakehouse.write_low_sales_alerts(
        spark.read.parquet(f"{out_root}/gold/enriched_sales"), params, out_root
    )
    return report


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sales", required=True)
    ap.add_argument("--customers", required=True)
    ap.add_argument("--products", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--alert-threshold", type=Decimal, default=RetailParams().sales_alert_threshold,
                    help="daily revenue below this raises a low-sales alert")
    ap.add_argument("--price-floor", type=Decimal, default=RetailParams().price_floor,
                    help="a sale is valid only when price is above this")
    args = ap.parse_args(argv)
    params = RetailParams(sales_alert_threshold=args.alert_threshold, price_floor=args.price_floor)
    spark = SparkSession.builder.getOrCreate()
    report = run_batch_job(spark, args.sales, args.customers, args.products, args.out, params)
    print(json.dumps(report.__dict__, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
