"""Input-layout and shared-folder guarantees claimed in the README."""

import pathlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from ledgerline.sources import tables


def _copy_tables(to, lines=None):
    for t in ("lineitem", "orders", "customer", "nation", "part", "events"):
        rows = pq.read_table(f"{SMOKE_DIR}/{t}.parquet")
        pq.write_table(rows.slice(0, lines) if t == "lineitem" and lines else rows, f"{to}/{t}.parquet")


def test_fact_scans_get_no_extra_shuffle(spark):
    for name in ("lineitem", "events"):
        df = tables.read_table(spark, SMOKE_DIR, name)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_changed_table_is_seen_and_layers_are_reused(spark, tmp_path):
    from ledgerline.plans.catalog import QUERIES, Retail

    total = lambda: QUERIES["total_sales"](spark, str(tmp_path)).first()[0]
    _copy_tables(tmp_path)
    before, root = total(), Retail(spark, str(tmp_path)).root
    files = {f: f.stat().st_mtime_ns for f in pathlib.Path(root.replace("file:", "")).rglob("*.parquet")}
    assert files
    assert total() == before
    again = {f: f.stat().st_mtime_ns for f in pathlib.Path(root.replace("file:", "")).rglob("*.parquet")}
    assert again == files  # nothing was written a second time
    _copy_tables(tmp_path, lines=3000)
    half = total()
    assert 0 < half < before
    want = Retail(spark, str(tmp_path), materialize=False).sales().agg(F.sum("revenue")).first()[0]
    assert half == float(want)


def test_lines_without_order_and_odd_numbers_are_rejected(spark, tmp_path):
    import pyarrow as pa

    from ledgerline.plans.catalog import Retail
    from ledgerline.operators import quality

    _copy_tables(tmp_path)
    lines = pq.read_table(f"{tmp_path}/lineitem.parquet").to_pandas()
    lines.loc[0, "l_orderkey"] = 10**12
    lines.loc[1, "l_extendedprice"] = 1e11
    lines.loc[2, "l_quantity"] = 2.5
    pq.write_table(pa.Table.from_pandas(lines, preserve_index=False), f"{tmp_path}/lineitem.parquet")
    raw = Retail(spark, str(tmp_path)).raw_sales()
    rejects = {r["reason"]: r["n"] for r in quality.rejected_rows(raw).collect()}
    assert rejects == {"null_key": 1, "null_number": 2}
    assert raw.count() == len(lines) == quality.clean_sales(raw).count() + 3


def test_layers_land_in_the_shared_folder(spark):
    from ledgerline.plans.catalog import Retail

    r = Retail(spark, SMOKE_DIR)
    r.sales()
    shared = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert r.root.replace("file:", "").startswith(shared.replace("file:", ""))
    files = r.sales().inputFiles()
    assert files and all("/silver/sales/store_id=" in f for f in files)
