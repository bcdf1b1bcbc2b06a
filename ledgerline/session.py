"""Session and shared-folder helpers.

Library code never fixes the master or lowers the shuffle width (``wide_shuffles``
raises it while a large table is written); ``build_session`` is for tests, the
bench and local jobs. ``shared_dir`` resolves where jobs may
write intermediate tables and stream checkpoints: the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent (local
tests) is a local folder created and registered.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "ledgerline",
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    When the setting is absent, a local folder is created only in local mode
    (tests); on a cluster a machine-local folder would not be visible to the
    executors, so that is an error.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by all executors"
            )
        base = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the shared root (never reused; Spark's writers create it)."""
    return "/".join([shared_root(spark), "ledgerline", *parts, uuid.uuid4().hex])


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders_state(spark: SparkSession, folders: list[str]) -> tuple:
    """Number, bytes and a hash of the files below some folders, listed and summed up by Spark.

    The listing runs in the JVM, on the executors where folders are many; one
    row comes back however many files there are. No file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    mark = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.bit_xor(mark)).first())


def fingerprint(spark: SparkSession, paths: list[str], *more) -> str:
    """Changes whenever a file below ``paths`` (or a value of ``more``) does."""
    seen, folders = hashlib.sha256(repr(more).encode()), []
    for path in paths:
        where, fs = _file_system(spark, path)
        if not fs.exists(where):
            continue
        status = fs.getFileStatus(where)
        if status.isDirectory():
            folders.append(path)
        else:
            seen.update(repr((path, status.getLen(), status.getModificationTime())).encode())
    if folders:
        seen.update(repr((folders, _folders_state(spark, folders))).encode())
    return seen.hexdigest()[:32]


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files at or below ``paths`` (those that are there)."""
    found = [_file_system(spark, path) for path in paths]
    return sum(fs.getContentSummary(where).getLength() for where, fs in found if fs.exists(where))


# Parquet input behind one shuffle partition: its rows, joined with their dimensions, sort in memory.
BYTES_PER_PARTITION = 8 << 20
SHUFFLE_WIDTH = "spark.sql.shuffle.partitions"


@contextmanager
def wide_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Within, shuffles have at least as many partitions as ``input_bytes`` ask for.

    A session's width that suits small tables gives partitions which grow with
    the input until their sorts spill; AQE merges partitions that are too small
    but can't split those of a join's sort. The session's own width, where
    larger, stays.
    """
    before = spark.conf.get(SHUFFLE_WIDTH)
    spark.conf.set(SHUFFLE_WIDTH, str(max(int(before), -(-input_bytes // BYTES_PER_PARTITION))))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_WIDTH, before)


def completed(spark: SparkSession, root: str, table: str) -> str | None:
    """The folder of the first complete copy ``root/<build>/table`` (Spark's ``_SUCCESS`` file tells).

    Every build writes to a folder of its own, so builds that run at once don't
    meet; each complete copy is as good as another.
    """
    where, fs = _file_system(spark, f"{root}/*/{table}/_SUCCESS")
    found = sorted(f.getPath().getParent().toString() for f in fs.globStatus(where) or [])
    return found[0] if found else None
