"""Held-out quality of the learned operators, on rows that they did not learn from."""

from pyspark.sql import functions as F

from ledgerline.llm.catalog import QUERIES
from ledgerline.llm.common import table

SF = "/root/testdata/sf0.1"


def _held(spark, query, label):
    rows = QUERIES[query](spark, SF).filter("held_out").select("doc_id", "predicted", "score")
    labels = table(spark, SF, "labels").select("doc_id", F.col(label).cast("int").alias("y")).filter("y IS NOT NULL")
    return rows.join(labels, "doc_id").select("y", "predicted").toPandas()


def test_toxicity(spark):
    rows = _held(spark, "op7_toxicity", "toxic")
    toxic, clean = rows[rows.y == 1], rows[rows.y == 0]
    assert len(toxic) > 50 and (toxic.predicted == 1).mean() >= 0.9
    assert (clean.predicted == 0).mean() >= 0.995


def test_quality(spark):
    rows = _held(spark, "op9_quality", "quality")
    for y in (0, 1):
        own = rows[rows.y == y]
        assert len(own) > 50 and (own.predicted == y).mean() >= 0.97


def test_language_model_beats_its_base(spark):
    rows = QUERIES["op2_lm_scoring"](spark, SF).filter("held_out")
    score, base, n = rows.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert score / n > base / n + 0.3
