"""Layers: fingerprints of folders, several builds at once, other code, exact audit counts, damaged lines."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from ledgerline.operators import measures, quality, star
from ledgerline.plans import catalog, lakehouse
from ledgerline.plans.catalog import Retail, damaged_lines
from ledgerline.session import completed, fingerprint, shared_dir
from ledgerline.sources import read_sales_csv


def test_fingerprint_follows_files_and_folders(spark, tmp_path):
    one = tmp_path / "one.parquet"
    one.write_bytes(b"abc")
    folder = tmp_path / "many.parquet" / "part=1"
    folder.mkdir(parents=True)
    (folder / "a").write_bytes(b"abc")
    mark = lambda: fingerprint(spark, [str(one), str(tmp_path / "many.parquet"), str(tmp_path / "none")], 7)
    first = mark()
    assert first == mark()
    (folder / "b").write_bytes(b"x")
    second = mark()
    assert second != first
    (folder / "b").write_bytes(b"xy")
    assert mark() != second
    third = mark()
    os.utime(one, (1, 1))
    assert mark() != third


def test_a_half_written_build_is_not_read_and_builds_do_not_meet(spark):
    r = Retail(spark, SMOKE_DIR, catalog.QUERY_PARAMS.with_(top_k_products=71))
    path = shared_dir(spark, "half")
    spark.range(3).write.parquet(f"{path}/b/table")
    assert completed(spark, path, "table").endswith("/b/table")
    spark.range(3).write.parquet(f"{path}/a/table")
    os.remove(f"{path.replace('file:', '')}/a/table/_SUCCESS")
    assert completed(spark, path, "table").endswith("/b/table")
    # A second builder that found nothing yet writes beside the first one; the folder outlives sessions.
    name, builds = f"mine{uuid.uuid4().hex}", []
    r.stored(name, lambda root: (builds.append(root), spark.range(1).write.parquet(f"{root}/{name}")))
    other = Retail(spark, SMOKE_DIR, r.params)
    other._own = {}
    spark.range(1).write.parquet(f"{r.root}/zzz/{name}")
    found = other.stored(name, lambda root: builds.append(root))
    assert found.removeprefix("file:") == f"{builds[0]}/{name}".removeprefix("file:")
    assert len(builds) == 1


def test_other_code_gives_other_layers(spark, monkeypatch):
    before = Retail(spark, SMOKE_DIR).root
    assert Retail(spark, SMOKE_DIR).root == before
    monkeypatch.setattr(catalog, "layer_code", lambda: "other")
    assert Retail(spark, SMOKE_DIR).root != before


def test_frames_of_stored_layers_are_kept(spark):
    assert Retail(spark, SMOKE_DIR).sales() is Retail(spark, SMOKE_DIR).sales()


def test_audit_counts_committed_rows_only(spark, tmp_path, retail_csv):
    raw = retail_csv["sales"]
    for _ in range(2):  # a repeated write replaces the tables
        lakehouse.write_silver_sales(quality.clean_sales(raw), str(tmp_path))
        lakehouse.write_rejects(raw, str(tmp_path))
    audit = {r["layer"]: r["n"] for r in lakehouse.sales_audit(spark, str(tmp_path)).collect()}
    want = {f"rejected:{r['reason']}": r["n"] for r in quality.rejected_rows(raw).collect()}
    assert audit == {"silver": quality.clean_sales(raw).count(), **want}
    assert sum(audit.values()) == raw.count()


def test_damaged_lines_read_back(spark, tmp_path):
    rows = [(str(i), "c", "p", "S1", 2, 3.0, dt.datetime(2024, 1, 1)) for i in range(20)] + [(None, "c", "p", None, None, None, None)]
    shape = "transaction_id string, customer_id string, product_id string, store_id string, quantity int, price decimal(12,2), timestamp timestamp"
    raw = spark.createDataFrame([(*r[:5], None if r[5] is None else __import__("decimal").Decimal(r[5]), r[6]) for r in rows], shape)
    lines = [r.line for r in damaged_lines(raw).collect()]
    head = "transaction_id,customer_id,product_id,store_id,quantity,price,timestamp"
    (tmp_path / "a.csv").write_text("\n".join([head, *lines]) + "\n")
    back = read_sales_csv(spark, str(tmp_path))
    assert back.count() == 21
    reasons = {r.transaction_id: r.reason for r in quality.rejected_records(back).collect()}
    assert reasons == {"1": "malformed", "3": "malformed", "4": "null_key", "5": "null_number", "6": "non_positive", None: "null_key"}
    clean = {r.transaction_id: r for r in quality.clean_sales(back).collect()}
    assert clean["7"].timestamp is None and clean["2"].quantity == 2 and len(clean) == 15


def test_growth_by_day_fills_the_calendar(spark):
    day = lambda m, d: dt.datetime(2024, m, d, 9)
    rows = [(day(1, 30), "10.00"), (day(1, 31), "5.00"), (day(3, 1), "30.00"), (day(3, 31), "15.00"), (None, "9.00")]
    fact = spark.createDataFrame(rows, "timestamp timestamp, r string").select("timestamp", F.col("r").cast("decimal(23,2)").alias("revenue"))
    got = {r.date: r for r in measures.growth_by_day(fact, star.dim_date(fact)).collect()}
    assert len(got) == 62  # every day from 01-30 to 03-31
    assert (got[dt.date(2024, 1, 31)].mtd, got[dt.date(2024, 1, 31)].last_mtd) == (15.0, 0.0)
    assert (got[dt.date(2024, 2, 29)].mtd, got[dt.date(2024, 2, 29)].last_mtd) == (0.0, 0.0)  # 01-29 is no day here
    assert (got[dt.date(2024, 3, 31)].mtd, got[dt.date(2024, 3, 31)].last_mtd) == (45.0, 0.0)
    assert got[dt.date(2024, 2, 28)].revenue == 0.0


def test_damaged_files_are_written_where_the_lines_are(spark, tmp_path):
    """Every file begins with the header and no line is dealt out or sorted for it: a small input gives one file."""
    r = Retail(spark, SMOKE_DIR, catalog.QUERY_PARAMS.with_(top_k_products=72))
    r._root = str(tmp_path)
    r._own = {}
    read = r.csv_corrupt_sales()
    files = [f for f in tmp_path.rglob("part-*") if f.stat().st_size]
    assert 0 < len(files) < int(spark.conf.get("spark.sql.shuffle.partitions"))
    head = "transaction_id,customer_id,product_id,store_id,quantity,price,timestamp"
    texts = [f.read_text().splitlines() for f in files]
    assert all(t[0] == head for t in texts)
    lines = [line for t in texts for line in t[1:]]
    assert sorted(lines) == sorted(x.line for x in damaged_lines(r.raw_sales()).collect())
    assert read.count() == len(lines)


def test_layers_are_written_with_shuffles_as_wide_as_the_input_asks(spark, monkeypatch):
    """Eight times the input gives eight times the partitions; the session's width is never lowered and comes back."""
    from ledgerline import session

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    size = os.path.getsize(f"{SMOKE_DIR}/lineitem.parquet")
    assert session.stored_bytes(spark, [f"{SMOKE_DIR}/lineitem.parquet", f"{SMOKE_DIR}/none.parquet"]) == size
    assert session.stored_bytes(spark, [SMOKE_DIR]) > size
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1 << 10)
    r, seen = Retail(spark, SMOKE_DIR, catalog.QUERY_PARAMS.with_(top_k_products=73)), []

    def write(root):
        seen.append(int(spark.conf.get(key)))
        spark.range(1).write.parquet(f"{root}/{name}")

    name = f"wide{uuid.uuid4().hex}"
    r.stored(name, write)
    assert seen == [max(int(before), -(-session.stored_bytes(spark, r.source_paths) // 1024))]
    assert spark.conf.get(key) == before
    with session.wide_shuffles(spark, 1):
        assert spark.conf.get(key) == before
