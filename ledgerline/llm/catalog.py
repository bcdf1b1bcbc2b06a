"""The corpus operators' queries over a table directory, and their SQL.

Every query applies its operator, with production parameters, to the whole
table. SQL is given where it can express the result; the other queries are
held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import (
    bpe_codec,
    decontamination,
    hard_negatives,
    lm_scoring,
    packing,
    quality,
    resampling,
    simhash,
    token_counts,
    topk,
    toxicity,
    training_shards,
    warc,
)
from ledgerline.llm.common import id_mod, table


def op1_token_counts(spark, sf_dir):
    """Tokens of every document, before and after the edits that remove personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = token_counts.count_tokens(docs, edits=token_counts.redactions(F.col("text")))
    return docs.select("doc_id", counts.alias("c")).select("doc_id", "c.*")


def op2_lm_scoring(spark, sf_dir):
    """Base and model log10 probability of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = id_mod(F.col("doc_id"), 7)
    scored = lm_scoring.score_documents(docs, "text", part != 2)
    return scored.select(
        "doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_best_fit_packing(spark, sf_dir):
    """Every document's pieces with their bins; near copies are kept apart."""
    return packing.pack(table(spark, sf_dir, "documents"), near=True)


def op4_top_k_search(spark, sf_dir):
    """The 5 best other vectors of every query vector."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(
        rows, "vec_id", topk.integer_components(F.col("embedding")), F.col("vec_id") % 50 == 0
    )


def op5_training_shards(spark, sf_dir):
    """Every training sequence as read back from its slot."""
    rows = training_shards.materialise(table(spark, sf_dir, "documents"))
    return rows.drop("ids")


def op6_decontamination(spark, sf_dir):
    """Benchmark words, items and verdict of every document."""
    found = decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        (id_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        toxicity.score_column(F.col("text"), grammar).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_warc(spark, sf_dir):
    """Every page as read back from the archives; the payload where its record holds it."""
    captures = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return captures.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        F.col("response.payload").alias("payload"),
    )


def op9_quality(spark, sf_dir):
    """Quality score of every document, with the scores of the two views."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = quality.score_columns(model, F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars"))
    scored = docs.select(
        "doc_id", (id_mod(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("s")
    ).select("doc_id", "held_out", "s.*")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_simhash(spark, sf_dir):
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_importance_resampling(spark, sf_dir):
    """Weight, score and rank of every document, drawn towards the benchmark's words."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_codec(spark, sf_dir):
    """Digests of every document's token ids and of the text that they decode to."""
    vocabulary = bpe_codec.read_vocabulary()
    docs = table(spark, sf_dir, "documents")
    encoded = docs.select("doc_id", bpe_codec.encode(F.col("text"), vocabulary).alias("ids"))
    decoded = encoded.select("doc_id", "ids", bpe_codec.decode(F.col("ids"), vocabulary).alias("decoded"))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_hard_negatives(spark, sf_dir):
    """The hardest negatives of every anchor and positive."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        rows, "vec_id", moved, topk.integer_components(F.col("embedding")), F.col("vec_id") % 100 == 0
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_lm_scoring,
        op3_best_fit_packing,
        op4_top_k_search,
        op5_training_shards,
        op6_decontamination,
        op7_toxicity,
        op8_warc,
        op9_quality,
        op10_simhash,
        op11_importance_resampling,
        op12_bpe_codec,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op4_top_k_search": """
        WITH x AS (
            SELECT vec_id, unnest(embedding) AS e, unnest(range(len(embedding))) AS pos
            FROM embeddings
            WHERE embedding IS NOT NULL
        ), bad AS (
            SELECT DISTINCT vec_id FROM x WHERE e IS NULL OR isnan(e) OR isinf(e)
        ), v AS (
            SELECT vec_id, pos, CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT) AS c
            FROM x WHERE vec_id NOT IN (SELECT vec_id FROM bad)
        ), s AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(sum(q.c * d.c) AS BIGINT) AS score
            FROM v q JOIN v d ON q.pos = d.pos AND q.vec_id <> d.vec_id
            WHERE q.vec_id % 50 = 0
            GROUP BY 1, 2
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), bp AS (
            SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
            FROM b WHERE len(w) > 0
        ), bw AS (
            SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g FROM bp
        ), sizes AS (SELECT DISTINCT m FROM bw),
        dp AS (
            SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
            FROM d, sizes WHERE len(w) >= m
        ), hits AS (
            SELECT dp.doc_id, dp.p, dp.m, bw.item_id
            FROM dp JOIN bw ON dp.m = bw.m AND array_to_string(dp.w[dp.p:dp.p + dp.m - 1], ' ') = bw.g
        ), words AS (
            SELECT doc_id, count(*) AS n_hit FROM (
                SELECT DISTINCT doc_id, unnest(range(p, p + m)) AS at FROM hits) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (
                SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
               CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items.ids, '')) AS items_sha256,
               coalesce(words.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), f AS (
            SELECT body, min(page_id) AS first FROM p WHERE strlen(body) >= 100 GROUP BY body
        )
        SELECT p.page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes, sha256(p.body) AS payload_digest,
               CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first < p.page_id THEN f.first END AS refers_to,
               CASE WHEN f.first < p.page_id THEN NULL ELSE p.body END AS payload
        FROM p LEFT JOIN f ON p.body = f.body
    """,
    # A word's crc32 by the table method, over the distinct words only.
    "op11_importance_resampling": r"""
        WITH polynomial AS (
            SELECT list(r ORDER BY i) AS t FROM (
                SELECT i, list_reduce(range(8),
                    lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, i) AS r
                FROM (SELECT unnest(range(256)) AS i))
        ), both_sides AS (
            SELECT 's' AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
            UNION ALL SELECT 't', NULL, item_id, text FROM benchmark
        ), lists AS (
            SELECT side, row, id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM both_sides
        ), uses AS (
            SELECT side, row, word, count(*) AS k FROM (SELECT side, row, unnest(w) AS word FROM lists)
            GROUP BY ALL
        ), bytes AS (
            SELECT word, list_transform(range(1, strlen(word) + 1),
                lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)) AS b
            FROM (SELECT DISTINCT word FROM uses)
        ), buckets AS (
            SELECT word, xor(list_reduce(b,
                lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM bytes, polynomial
        ), counts AS (
            SELECT bucket, coalesce(sum(k) FILTER (side = 's'), 0) AS s, coalesce(sum(k) FILTER (side = 't'), 0) AS t
            FROM uses JOIN buckets USING (word) GROUP BY bucket
        ), totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(
                CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
            FROM counts, totals
        ), sums AS (
            SELECT row, sum(k * g) AS total FROM uses JOIN buckets USING (word) JOIN gain USING (bucket)
            WHERE side = 's' GROUP BY row
        ), weighted AS (
            SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_features,
                CAST(CASE WHEN len(w) = 0 THEN 0
                     ELSE (total - ((total % len(w)) + len(w)) % len(w)) // len(w) END AS BIGINT) AS weight,
                CAST('0x' || substr(sha256('2024:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) AS h
            FROM lists LEFT JOIN sums USING (row) WHERE side = 's'
        ), scored AS (
            SELECT doc_id, n_features, weight,
                weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM weighted
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                count(*) FILTER (n_features >= 20) OVER () AS n
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
            CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN CAST(place AS BIGINT) END AS rank
        FROM ranked
    """,
    "op13_hard_negatives": """
        WITH x AS (
            SELECT vec_id, unnest(embedding) AS e, unnest(range(len(embedding))) AS pos
            FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
        ), bad AS (
            SELECT DISTINCT vec_id FROM x WHERE e IS NULL OR isnan(e) OR isinf(e)
        ), v AS (
            SELECT vec_id, pos, CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT) AS c
            FROM x WHERE vec_id NOT IN (SELECT vec_id FROM bad)
        ), l AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
        ), s AS (
            SELECT a.vec_id AS anchor_id, d.vec_id, CAST(sum(a.c * d.c) AS BIGINT) AS score
            FROM v a JOIN v d ON a.pos = d.pos AND a.vec_id <> d.vec_id
            WHERE a.vec_id % 100 = 0
            GROUP BY 1, 2
        ), t AS (
            SELECT s.*, la.label = ld.label AS same
            FROM s JOIN l la ON s.anchor_id = la.vec_id JOIN l ld ON s.vec_id = ld.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
                FROM t WHERE same)
            WHERE place <= 5
        ), n AS (
            SELECT p.*, t.vec_id AS negative_id, t.score AS negative_score, CAST(row_number() OVER (
                PARTITION BY p.anchor_id, p.positive_id ORDER BY t.score DESC, t.vec_id) AS INTEGER) AS rank
            FROM p JOIN t ON p.anchor_id = t.anchor_id AND NOT t.same
                AND 30 * p.positive_score <= 100 * t.score AND 100 * t.score <= 90 * p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
}
