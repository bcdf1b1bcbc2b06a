"""Structured Streaming: emission under the watermark, late data, resume, stream = batch."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from ledgerline.params import RetailParams
from ledgerline.sources import events_from_tables, events_stream_from_tables, sales_csv_stream
from ledgerline.streaming import demand_spikes, run_demand_stream, windowed_demand

HEADER = "transaction_id,customer_id,product_id,store_id,quantity,price,timestamp\n"
BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


_ARRIVAL = [0]


def _write_batch(directory, name, minute, quantities):
    """Write one input file; files "arrive" in call order.

    The file source orders new files by modification time, and files written
    in the same instant can share one, so each file gets a strictly later
    mtime than the previous one to make the arrival order explicit.
    """
    lines = [HEADER]
    for i, (product, qty) in enumerate(quantities):
        ts = BASE + dt.timedelta(minutes=minute, seconds=5 * i)
        lines.append(f"T{minute:02d}{i},C1,{product},S1,{qty},10.00,{ts:%Y-%m-%d %H:%M:%S}\n")
    path = os.path.join(directory, name)
    with open(path, "w") as f:
        f.writelines(lines)
    _ARRIVAL[0] += 1
    arrival = time.time() - 100000 + _ARRIVAL[0] * 10
    os.utime(path, (arrival, arrival))


FOUR_ROWS = [("P1", 1), ("P2", 2), ("P1", 3), ("P2", 4)]


@pytest.fixture()
def stream_dirs(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for n, minute in enumerate((0, 10, 20)):
        _write_batch(src, f"batch_{n:03d}.csv", minute, FOUR_ROWS)
    return {"src": str(src), "sink": str(tmp_path / "out"), "ckpt": str(tmp_path / "ckpt")}


def _run(spark, dirs):
    stream = sales_csv_stream(spark, dirs["src"], max_files_per_trigger=1)
    return run_demand_stream(stream, dirs["sink"], dirs["ckpt"], window="1 minute", watermark="5 minutes", timeout_s=300)


def _sink(spark, dirs):
    return spark.read.parquet(dirs["sink"])


def test_available_now_emits_closed_windows_only(spark, stream_dirs):
    res = _run(spark, stream_dirs)
    out = _sink(spark, stream_dirs).collect()
    minutes = sorted({r["window_start"].minute for r in out})
    assert len(out) == 4
    assert minutes == [0, 10]  # the minute-20 window is still open
    got = {(r["window_start"].minute, r["product_id"]): (r["total_qty"], r["window_revenue"]) for r in out}
    assert got[(0, "P1")] == (4, 40.0)
    assert got[(10, "P2")] == (6, 60.0)
    assert res.input_rows == 12
    assert res.batches >= 3  # maxFilesPerTrigger=1 honoured by availableNow: one file per batch


def test_late_file_dropped_and_rerun_adds_nothing(spark, stream_dirs):
    _run(spark, stream_dirs)
    before = sorted(map(tuple, _sink(spark, stream_dirs).collect()))
    _write_batch(stream_dirs["src"], "batch_003.csv", 1, FOUR_ROWS)  # late: minute 1
    res = _run(spark, stream_dirs)
    after = sorted(map(tuple, _sink(spark, stream_dirs).collect()))
    assert after == before
    assert res.rows_dropped_by_watermark == 2  # counted after partial aggregation
    # A file rewritten under a name already seen is not read again.
    _write_batch(stream_dirs["src"], "batch_000.csv", 30, FOUR_ROWS)
    res2 = _run(spark, stream_dirs)
    assert res2.input_rows == 0
    assert sorted(map(tuple, _sink(spark, stream_dirs).collect())) == before


def test_two_stage_resume_equals_one_run(spark, tmp_path, stream_dirs):
    _run(spark, stream_dirs)
    one_run = sorted(map(tuple, _sink(spark, stream_dirs).collect()))
    src2 = tmp_path / "in2"
    src2.mkdir()
    dirs2 = {"src": str(src2), "sink": str(tmp_path / "out2"), "ckpt": str(tmp_path / "ckpt2")}
    _write_batch(src2, "batch_000.csv", 0, FOUR_ROWS)
    _write_batch(src2, "batch_001.csv", 10, FOUR_ROWS)
    _run(spark, dirs2)
    _write_batch(src2, "batch_002.csv", 20, FOUR_ROWS)
    _run(spark, dirs2)
    assert sorted(map(tuple, _sink(spark, dirs2).collect())) == one_run


def test_stream_rows_are_cleaned(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with open(src / "a.csv", "w") as f:
        f.write(HEADER)
        f.write("T1,C1,P1,S1,5,10.00,2024-01-01 00:00:01\n")
        f.write("T2,C1,P1,S1,-5,10.00,2024-01-01 00:00:02\n")  # non-positive: dropped
        f.write("T3,C1,P1,S1,5,10.00,garbage\n")  # no event time: no window
        f.write("T4,C1,P1,S1,1,10.00,2024-01-01 00:30:00\n")
    batch = spark.read.option("header", True).schema(sales_csv_stream(spark, str(src)).schema).csv(str(src))
    rows = windowed_demand(batch, window="1 minute").collect()
    got = {r["window_start"].minute: r["total_qty"] for r in rows}
    assert got == {0: 5, 30: 1}


def test_stream_equals_batch_twin_on_events(spark, tmp_path):
    params = RetailParams(window_duration="1 hour")
    batch = windowed_demand(events_from_tables(spark, SMOKE_DIR), window="1 hour", params=params)
    max_ts = events_from_tables(spark, SMOKE_DIR).agg(F.max("timestamp")).first()[0]
    cutoff = (max_ts - dt.timedelta(minutes=5)).replace(tzinfo=None)
    expected = sorted(map(tuple, batch.filter(F.col("window_end") <= F.lit(cutoff)).collect()))
    stream = events_stream_from_tables(spark, SMOKE_DIR)
    run_demand_stream(stream, str(tmp_path / "o"), str(tmp_path / "c"), window="1 hour", watermark="5 minutes", params=params)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "o")).select(*batch.columns).collect()))
    assert got == expected
    assert len(got) > 0


def test_spikes_are_a_subset_of_windows_and_use_exact_baseline(spark):
    windows = spark.createDataFrame(
        [
            (BASE, BASE, "P1", 1, 1.0),
            (BASE, BASE, "P2", 1, 1.0),
            (BASE, BASE, "P3", 1, 1.0),
            (BASE, BASE, "P4", 9, 9.0),
        ],
        "window_start timestamp_ntz, window_end timestamp_ntz, product_id string, total_qty bigint, window_revenue double",
    )
    # mean = 3, so the threshold is 6: only P4 is a spike
    assert [r["product_id"] for r in demand_spikes(windows, Decimal("2.0")).collect()] == ["P4"]
    # exactly at factor x mean is not a spike (strict >)
    assert demand_spikes(windows, Decimal("3.0")).count() == 0
    empty = windows.filter(F.lit(False))
    assert demand_spikes(empty).count() == 0


def test_counts_are_exact_beyond_a_hundred_batches(spark, tmp_path):
    """Spark keeps the reports of the last 100 batches; the counts cover all of them."""
    from ledgerline.sources import sales_csv_stream

    src = tmp_path / "in"
    src.mkdir()
    head = "transaction_id,customer_id,product_id,store_id,quantity,price,timestamp\n"
    for i in range(104):
        (src / f"f{i:03d}.csv").write_text(head + f"t{i},c,p,S1,1,2.50,2024-01-01 00:{i % 60:02d}:00\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "20")
    try:
        result = run_demand_stream(
            sales_csv_stream(spark, str(src), max_files_per_trigger=1),
            sink_path=str(tmp_path / "out"),
            checkpoint_path=str(tmp_path / "ckpt"),
        )
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert result.input_rows == 104
    assert result.batches >= 104


def test_a_replayed_batch_changes_nothing(spark, stream_dirs, tmp_path):
    from ledgerline.streaming import batch_sink

    schema = "window_start timestamp_ntz, window_end timestamp_ntz, product_id string, total_qty bigint, window_revenue double"
    root = str(tmp_path / "batches")
    calls = []

    def again(batch, batch_id):
        calls.append(batch_id)
        batch_sink.write_batch(batch, batch_id, root)

    windows = windowed_demand(sales_csv_stream(spark, stream_dirs["src"], max_files_per_trigger=1), watermark="5 minutes")
    n = batch_sink.drain_batches(windows, root, stream_dirs["ckpt"], after=again)
    assert n == 3 and len(calls) >= 3
    got = batch_sink.read_batches(spark, root, schema)
    _run(spark, {**stream_dirs, "ckpt": str(tmp_path / "other")})
    assert sorted(map(tuple, got.drop("batch_id").collect())) == sorted(map(tuple, _sink(spark, stream_dirs).collect()))
    assert got.groupBy("window_start", "window_end", "product_id").count().filter("count > 1").count() == 0


def test_latest_batch_of_a_complete_sink(spark, stream_dirs, tmp_path):
    from ledgerline.streaming import batch_sink

    root = str(tmp_path / "batches")
    windows = windowed_demand(sales_csv_stream(spark, stream_dirs["src"], max_files_per_trigger=1))
    assert batch_sink.drain_batches(windows, root, stream_dirs["ckpt"], mode="complete") == 3
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, product_id string, total_qty bigint, window_revenue double"
    batch = spark.read.option("header", True).schema(sales_csv_stream(spark, stream_dirs["src"]).schema).csv(stream_dirs["src"])
    want = sorted(map(tuple, windowed_demand(batch).collect()))
    assert sorted(map(tuple, batch_sink.latest_batch(spark, root, schema).collect())) == want


@pytest.mark.parametrize("limit", [0.0, 0.5, 1.0, 1.5])
def test_stop_at_any_moment_and_more_files(spark, stream_dirs, limit):
    stream = lambda: sales_csv_stream(spark, stream_dirs["src"], max_files_per_trigger=1)
    run_demand_stream(stream(), stream_dirs["sink"], stream_dirs["ckpt"], timeout_s=limit, on_timeout="return")
    _write_batch(stream_dirs["src"], "batch_003.csv", 30, FOUR_ROWS)
    assert run_demand_stream(stream(), stream_dirs["sink"], stream_dirs["ckpt"]).finished
    out = _sink(spark, stream_dirs).collect()
    assert len(out) == 6 and sum(r["total_qty"] for r in out) == 30


def test_time_limit_reports_and_resumes(spark, stream_dirs):
    import pytest as pt

    stream = lambda: sales_csv_stream(spark, stream_dirs["src"], max_files_per_trigger=1)
    with pt.raises(TimeoutError):
        run_demand_stream(stream(), stream_dirs["sink"], stream_dirs["ckpt"], timeout_s=0.0)
    part = run_demand_stream(stream(), stream_dirs["sink"], stream_dirs["ckpt"], timeout_s=0.0, on_timeout="return")
    assert not part.finished
    rest = run_demand_stream(stream(), stream_dirs["sink"], stream_dirs["ckpt"])
    assert rest.finished
    out = _sink(spark, stream_dirs).collect()
    assert len(out) == 4 and sum(r["total_qty"] for r in out) == 20
