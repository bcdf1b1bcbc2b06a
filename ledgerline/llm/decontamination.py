"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's words are hashed in runs of k (k-grams), and of every ``w``
consecutive k-gram hashes the smallest is kept, the last one of equals:
its fingerprint. Two texts that share a span of ``k + w - 1`` words share a
fingerprint inside it. With ``k + w - 1 = window`` no window that a document
shares with an item can be missed, and only about 2 / (w + 1) of the
positions of a document go into the join.

An item of fewer words than ``window`` is one window of its own length m; for
each such length that occurs in the benchmark (fewer than ``window`` of them)
k and w are chosen with ``k + w - 1 = m``.

Steps: (1) fingerprints of the items; (2) fingerprints of the documents,
joined with (1); (3) hits are extended: each window of the document that
covers a hit is rebuilt from the words around it and joined with the items'
windows, word for word; (4) per document, the words inside windows found and
the items they come from are counted.

The item fingerprints are broadcast while they are at most
``broadcast_rows``; beyond that the documents' fingerprints are shuffled to
them by hash, and the words around hits are fetched by a second join, so that
texts are never shuffled with the fingerprints. Both ways give equal results.
Documents with one very common passage meet the items' windows in a join that
adaptive execution may split.

Defined cases: a null text has no words; a document without words is not
contaminated; items without words are no windows; rows equal in id and text
give one result each, with equal values; a null id is kept; items that repeat
count once per item_id; a null item_id takes no part in the item list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import ascii_lower, fresh
from ledgerline.session import shared_dir

# Fixed value: a word, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 4_000_000  # at about 24 bytes: 100 MB at most
PLACE = (1 << 28) - 1  # more words than an array of strings can hold


@dataclass(frozen=True)
class Scheme:
    """Windows of ``window`` words, found through k-grams of which one in w is kept."""

    window: int
    k: int

    @property
    def w(self) -> int:
        return self.window - self.k + 1


def scheme(window: int, k: int = 5) -> Scheme:
    return Scheme(window, min(window, k))


def words_of(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with the array of a text's words (null: none)."""
    low = fresh("low", [*df.columns, into])
    words = F.regexp_extract_all(F.coalesce(F.col(low), F.lit("")), F.lit(WORD), F.lit(0))
    return df.withColumn(low, ascii_lower(F.col(text))).withColumn(into, words).drop(low)


def fingerprints(words: str, s: Scheme) -> Column:
    """array<long>: the fingerprints of a word array, each with its place.

    A value holds the hash of (window, k-gram) in its upper 36 bits and, below,
    the place counted down, so the smallest of a window is the last of its
    equals. The word array and the hash array are bound as lambda variables, so
    each is computed once.
    """
    gram = ", ".join(f"a[i + {j}]" for j in range(s.k))
    hashes = (
        f"transform(sequence(0, size(a) - {s.k}), "
        f"i -> (xxhash64({gram}, {s.window}) & {~PLACE}L) | cast({PLACE} - i AS bigint))"
    )
    least = "h[i]" if s.w == 1 else "least(" + ", ".join(f"h[i + {j}]" for j in range(s.w)) + ")"
    kept = f"transform(sequence(0, size(h) - {s.w}), i -> {least})"
    return F.expr(
        f"CASE WHEN size({words}) >= {s.window} THEN array_distinct("
        f"transform(transform(array({words}), a -> {hashes}), h -> {kept})[0]"
        f") ELSE cast(array() AS array<bigint>) END"
    )


def hash_of(fp: str) -> Column:
    return F.expr(f"{fp} & {~PLACE}L")


def place_of(fp: str) -> Column:
    return F.expr(f"cast({PLACE}L - ({fp} & {PLACE}L) AS int)")


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, window, gram): the windows of each item, as words joined by blanks."""
    items = words_of(
        benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("t")), "t", "words"
    ).filter("size(words) > 0")
    grams = F.expr(
        "transform(sequence(0, size(words) - window), i -> array_join(slice(words, i + 1, window), ' '))"
    )
    return (
        items.withColumn("window", F.expr(f"least({window}, size(words))"))
        .select("item_id", "window", F.explode(grams).alias("gram"))
        .distinct()
    )


def item_fingerprints(benchmark: DataFrame, text: str, schemes: list[Scheme]) -> DataFrame:
    """(hash, window), distinct: the fingerprints of all items."""
    items = words_of(benchmark.select(F.col(text).alias("t")), "t", "words")
    full = max(s.window for s in schemes)
    out = None
    for s in schemes:
        fits = f"size(words) >= {s.window}" if s.window == full else f"size(words) = {s.window}"
        part = items.filter(fits).select(
            F.explode(fingerprints("words", s)).alias("fp"), F.lit(s.window).alias("window")
        )
        out = part if out is None else out.unionAll(part)
    return out.select(hash_of("fp").alias("hash"), "window").distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, key, n_words, n_hit, n_items, item_ids, contaminated.

    ``key`` is a hash of the text; ``item_ids`` are the items with occurring
    windows, sorted as strings.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "decontamination")

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    windows = stored("windows", item_windows(benchmark, item_id, item_text, window))
    # At most ``window`` lengths.
    lengths = {window, *(r[0] for r in windows.select("window").distinct().collect())}
    schemes = [scheme(m) for m in sorted(lengths)]
    known = stored("fingerprints", item_fingerprints(benchmark, item_text, schemes))

    rows = words_of(
        docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("t")),
        "t",
        "words",
    ).select("doc_id", "key", "words", F.size("words").alias("n_words"))
    # A document's first row has no fingerprint; it stands for the document itself.
    prints = F.concat(F.expr("array(cast(null AS bigint))"), *[fingerprints("words", s) for s in schemes])
    found = rows.select("*", F.explode(prints).alias("fp")).select(
        "*", hash_of("fp").alias("hash"), place_of("fp").alias("at")
    )
    # The words around a hit: enough for every window that covers it.
    near = F.expr(f"CASE WHEN at IS NOT NULL THEN slice(words, greatest(at - {window}, 0) + 1, {2 * window}) END")
    if known.count() <= broadcast_rows:
        hits = (
            found.join(F.broadcast(known), "hash", "left")
            .filter("window IS NOT NULL OR fp IS NULL")
            .select("doc_id", "key", "n_words", "window", "at", near.alias("near"))
        )
    else:
        slim = found.select("doc_id", "key", "n_words", "fp", "hash", "at")
        heads = slim.filter("fp IS NULL").select(
            "doc_id", "key", "n_words", F.lit(None).cast("int").alias("window"), "at",
            F.lit(None).cast("array<string>").alias("near"),
        )
        matched = slim.join(known, "hash").select("doc_id", "key", "window", "at").distinct()
        hits = heads.unionAll(
            matched.alias("m")
            .join(rows.alias("o"), same_row("m", "o"))
            .select("m.doc_id", "m.key", "n_words", "window", "at", near.alias("near"))
        )
    hits = stored("hits", hits)

    # Extend: every window that covers the k-gram at ``at``, word for word.
    k_of = F.expr("CASE " + " ".join(f"WHEN window = {s.window} THEN {s.k}" for s in schemes) + " END")
    starts = (
        hits.filter("window IS NOT NULL")
        .select("*", k_of.alias("k"), F.expr(f"greatest(at - {window}, 0)").alias("first"))
        .select(
            "*",
            F.explode(
                F.expr("sequence(greatest(at - (window - k), 0), least(at, n_words - window))")
            ).alias("start"),
        )
        .select(
            "doc_id", "key", "window", "start",
            F.expr("array_join(slice(near, start - first + 1, window), ' ')").alias("gram"),
        )
        .distinct()
    )
    # Windows with the same items share a set, and documents carry the number of the set.
    items = stored(
        "items", windows.groupBy("window", "gram").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    sets = stored("sets", items.select("items").distinct().withColumn("set", F.monotonically_increasing_id()))
    grams = items.join(sets, "items").select("window", "gram", "set")
    spans = stored(
        "spans", starts.join(grams, ["window", "gram"]).select("doc_id", "key", "window", "start", "set")
    )

    # Words inside spans: what each span adds behind those that began before it.
    before = (
        Window.partitionBy("doc_id", "key")
        .orderBy("start", "end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    hit_words = (
        spans.select("doc_id", "key", "start", F.expr("start + window").alias("end"))
        .distinct()
        .withColumn("reach", F.max("end").over(before))
        .groupBy("doc_id", "key")
        .agg(F.sum(F.expr("greatest(end - greatest(start, coalesce(reach, 0)), 0)")).alias("n_hit"))
    )
    # Items are listed once for each combination of sets that some document holds.
    held = spans.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("set")).alias("sets"))
    listed = (
        held.select("sets")
        .distinct()
        .select("sets", F.explode("sets").alias("set"))
        .join(sets, "set")
        .select("sets", F.explode("items").alias("item_id"))
        .distinct()
        .groupBy("sets")
        .agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    )
    per_item = held.join(listed, "sets").select("doc_id", "key", "item_ids")
    heads = hits.filter("window IS NULL").select("doc_id", "key", "n_words")
    n_hit = F.coalesce("h.n_hit", F.lit(0)).cast("long")
    item_ids = F.coalesce("i.item_ids", F.expr("cast(array() AS array<string>)"))
    return (
        heads.alias("d")
        .join(hit_words.alias("h"), same_row("d", "h"), "left")
        .join(per_item.alias("i"), same_row("d", "i"), "left")
        .select(
            F.col("d.doc_id").alias("doc_id"),
            F.col("d.key").alias("key"),
            F.col("d.n_words").cast("long").alias("n_words"),
            n_hit.alias("n_hit"),
            F.size(item_ids).cast("long").alias("n_items"),
            item_ids.alias("item_ids"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same_row(a: str, b: str) -> Column:
    return F.expr(f"{a}.doc_id <=> {b}.doc_id AND {a}.key = {b}.key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) that hold no window of a benchmark item."""
    bad = contaminated(docs, benchmark, doc_id, text).filter("contaminated").select("doc_id", "key").distinct()
    key = fresh("key", docs.columns)
    keyed = docs.withColumn(key, text_key(F.col(text)))
    match = keyed[doc_id].eqNullSafe(bad["doc_id"]) & (keyed[key] == bad["key"])
    return keyed.join(bad, match, "left_anti").drop(key)
