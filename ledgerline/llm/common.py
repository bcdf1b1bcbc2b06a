"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(name: str, columns) -> str:
    """``name``, with underscores put before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_mod(col: Column, m: int) -> Column:
    """crc32 of an id as text, modulo ``m`` (a null id counts as empty text)."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(m))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else; a text of ASCII only takes the fast path."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space (``[^\\x20\\x09-\\x0D]+``), as UTF-8.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at exactly these
    six characters.
    """
    return text.encode().lower().split() if text else []
