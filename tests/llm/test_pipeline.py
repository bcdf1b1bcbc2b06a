"""The pipeline's rows against its stages done by hand on a whole small table."""

import corpus_pipeline
from ledgerline.llm import simhash
from ledgerline.llm.catalog import QUERIES
from ledgerline.llm.common import ascii_words, table

SF = "/root/testdata/sf0.01"


def _first_of_groups(prints):
    """The smallest id of each group of fingerprints linked at 3 bits."""
    at = {}
    for i, fp in prints.items():
        at.setdefault(fp, []).append(i)
    left, kept = set(at), set()
    while left:
        todo, group = [left.pop()], []
        while todo:
            a = todo.pop()
            group += at[a]
            near = {b for b in left if bin(a ^ b).count("1") <= 3}
            left -= near
            todo += near
        kept.add(min(group))
    return kept


def test_trained_stages_against_doing_them_by_hand(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    assert len(texts) == 1000
    scores = lambda q: {r.doc_id: r.score for r in QUERIES[q](spark, SF).select("doc_id", "score").collect()}
    toxic, quality = scores("op7_toxicity"), scores("op9_quality")
    left = {i for i in texts if toxic[i] < 0.5}
    assert 0 < len(left) < len(texts)
    good = {i for i in left if quality[i] >= 0.5}
    assert 0 < len(good) < len(left)
    alone = _first_of_groups({i: simhash.simhash(texts[i]) & (2**64 - 1) for i in good})
    assert len(alone) < len(good)
    marked = {r.doc_id for r in QUERIES["op6_decontamination"](spark, SF).filter("contaminated").collect()}
    kept = alone - marked
    assert len(kept) < len(alone)
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "bin_id", "n_words").collect()
    words = {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.n_words
    want = {i: len(ascii_words(texts[i])) for i in kept}
    assert words == {i: n for i, n in want.items() if n}
    room = {}
    for r in rows:
        room[r.bin_id] = room.get(r.bin_id, 0) + r.n_words
    assert max(room.values()) <= 2048
