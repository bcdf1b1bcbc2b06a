"""The operators' in-task parts against brute force, without Spark."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import pandas as pd

from ledgerline.llm import lm_scoring, packing, quality, simhash, token_counts, topk, toxicity, training_shards, warc
from ledgerline.llm.common import ascii_words, fresh
from ledgerline.llm.tokenizer import Chunks, Encoder, encoding, read_vocabulary

VOCAB = read_vocabulary()


def test_edits_equal_counting_the_edited_text_anew():
    split, encode = Chunks(VOCAB).leaves, encoding(VOCAB).encode_ordinary
    rnd, alphabet = random.Random(5), "ab'sltvred  \n\t.!9é　 \x1c\x85ß中"
    some = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    for _ in range(400):
        text = some(rnd.choice([0, 1, 3, 20, 90, 400]))
        edits = [
            (rnd.randrange(len(text) + 2), rnd.choice([0, 1, 5, 40]), some(rnd.choice([0, 1, 4, 200])))
            for _ in range(rnd.randrange(5))
        ]
        new, end, kept, skipped = text, -1, [], 0
        for s, n, r in sorted(edits, key=lambda e: e[0]):
            s = min(s, len(text))
            n = min(n, len(text) - s)
            if s < end:
                skipped += 1
                continue
            end = s + n
            kept.append((s, n, r))
        for s, n, r in reversed(kept):
            new = new[:s] + r + new[s + n :]
        got = token_counts.edited_counts(text, edits, split)
        assert got[1] == len(encode(text))
        assert (got[2], got[3]) == (len(kept), skipped)
        assert got[5:] == (len(encode(new)), len(new))


def test_edited_text_equals_plain_slicing():
    rnd = random.Random(12)
    for _ in range(300):
        plain = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(60)))
        text = token_counts.EditedText(plain)
        for _ in range(6):  # in any order, behind earlier edits too
            at = rnd.randrange(len(plain) + 1)
            n = min(rnd.randrange(8), len(plain) - at)
            new = "xyz"[: rnd.randrange(4)]
            plain = plain[:at] + new + plain[at + n :]
            text.replace(at, n, new)
            assert len(text) == len(plain)
            a, b = rnd.randrange(70), rnd.randrange(70)
            assert text.slice(a, b) == plain[a:b]


def test_many_edits_cost_no_more_each_than_few():
    """Work is counted as characters copied, not as time."""
    text = "some words here " * 20_000

    class Counted(str):
        copied = 0

        def __getitem__(self, key):
            out = str.__getitem__(self, key)
            Counted.copied += len(out)
            return out

    edited = token_counts.EditedText(Counted(text))
    for at in range(len(text) - 16, 0, -16):
        edited.replace(at, 4, "x")
        edited.slice(at - 8, at + 40)
    assert Counted.copied < 3 * len(text)


def test_an_edit_encodes_little_of_a_long_text():
    split = Chunks(VOCAB).leaves
    text = "some words here " * 5000
    got = token_counts.edited_counts(text, [(40000, 4, "thing")], split)
    assert got[4] < 200 < got[0]
    assert token_counts.edited_counts(None, None, split) == (0, 0, 0, 0, 0, 0, 0)


def test_gradients_of_the_recurrent_model():
    p = lm_scoring.LmParams(vocab=12, classes=4, hidden=3)
    hot = {lm_scoring.END: 5, **{b"w%d" % i: 20 - i for i in range(14)}}
    v = lm_scoring.build_vocabulary(hot, [(0, 200, 14)], p)
    w = {k: x.astype(np.float64) for k, x in lm_scoring.new_weights(v, p).items()}
    rng = np.random.default_rng(1)
    words = rng.integers(0, v.size + 2, (5, 3))
    words[2, 1] = 0
    targets = rng.integers(0, v.size + 2, (5, 3))
    state = rng.standard_normal((3, 3)) * 0.1
    loss = lambda: lm_scoring.train_window(w, v.starts, words, targets, state)[0]
    grads = lm_scoring.train_window(w, v.starts, words, targets, state)[1]
    met, rows = grads["x"]
    grads["x"] = np.zeros_like(w["x"])
    grads["x"][met] = rows
    for k, g in grads.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in g.shape)
            w[k][at] += 1e-3
            up = loss()
            w[k][at] -= 2e-3
            down = loss()
            w[k][at] += 1e-3
            assert abs((up - down) / 2e-3 - g[at]) < 2e-2 * max(1, abs(g[at])), (k, at)


def test_the_model_is_a_distribution_and_windows_carry_the_state():
    p = lm_scoring.LmParams(vocab=12, classes=4, hidden=3)
    hot = {lm_scoring.END: 5, **{b"w%d" % i: 20 - i for i in range(14)}}
    v = lm_scoring.build_vocabulary(hot, [(0, 200, 14)], p)
    w = lm_scoring.new_weights(v, p)
    first = [np.array([1, 2, t]) for t in range(v.size + lm_scoring.RARE)]
    total = sum(10 ** s for s in lm_scoring.score_batch(w, v.starts, first, p))
    two = 10 ** lm_scoring.score_batch(w, v.starts, [np.array([1, 2])], p)[0]
    assert abs(total / two - 1) < 1e-4
    long = [np.arange(100) % v.size, np.arange(7) % v.size]
    small = lm_scoring.LmParams(vocab=12, classes=4, hidden=3, window=3, batch=1)
    assert np.allclose(lm_scoring.score_batch(w, v.starts, long, p), lm_scoring.score_batch(w, v.starts, long, small), rtol=1e-5)


def test_packing_takes_the_tightest_compatible_bin():
    rnd = random.Random(3)
    for per_source in (1, 2):
        rows = pd.DataFrame(
            [
                dict(shard=0, has_id=True, doc_id=i, piece=0, copy=1, first_word=0, n_words=rnd.randint(1, 60),
                     source=rnd.choice("aaab") + "", cluster=rnd.randrange(60))
                for i in range(150)
            ]
        )
        got = packing.pack_shard(rows.copy(), 64, per_source).set_index("doc_id")
        bins = []  # brute force: every bin is looked at
        for r in rows.sort_values(["n_words", "doc_id"], ascending=[False, True]).itertuples():
            fits = [
                (b["room"], b["since"], b)
                for b in bins
                if b["room"] >= r.n_words and r.cluster not in b["clusters"] and b["sources"].count(r.source) < per_source
            ]
            if fits:
                room = min(f[0] for f in fits)
                b = min((f for f in fits if f[0] == room), key=lambda f: f[1])[2]
            else:
                b = dict(room=64, clusters=set(), sources=[], docs=[], since=0)
                bins.append(b)
            b["room"] -= r.n_words
            b["since"] = r.Index if False else len(got) + sum(len(x["docs"]) for x in bins)
            b["clusters"].add(r.cluster)
            b["sources"].append(r.source)
            b["docs"].append(r.doc_id)
        assert sorted(sorted(b["docs"]) for b in bins) == sorted(
            sorted(g.index) for _, g in got.groupby("bin_id")
        )


def test_maxscore_equals_brute_force():
    rng = np.random.default_rng(4)
    for n, dims in ((1, 4), (7, 3), (300, 16)):
        ids = rng.permutation(n * 2)[:n].astype(np.int64)
        rows = rng.integers(-20, 20, (n, dims)).astype(np.int64)
        rows[n // 2 :] = rows[: n - n // 2]  # ties
        index = topk.Postings(ids, rows)
        for q in range(min(n, 40)):
            own = int(ids[q])
            want = sorted(((-int(rows[i] @ rows[q]), int(ids[i])) for i in range(n) if ids[i] != own))[:5]
            assert [(-s, i) for s, i in index.search(rows[q], 5, own)] == want


def test_tickets_are_a_permutation():
    for n in (1, 2, 3, 10, 1000, 65537):
        slots = training_shards.permute(np.arange(n), n, 11)
        assert sorted(slots) == list(range(n))
        assert (training_shards.permute(slots, n, 11, inverse=True) == np.arange(n)).all()
    a, b = (training_shards.permute(np.arange(1000), 1000, k) for k in (1, 2))
    assert (a != b).any()
    assert list(Encoder(VOCAB).ids("a b")) == encoding(VOCAB).encode_ordinary("a b")


def test_transducers_compose():
    machine = toxicity.machine()
    g = toxicity.Grammar(words={"fool": 5.0}, stems={"lowe": 4.0})
    symbols = toxicity.Symbols(g)
    at = lambda text: toxicity.features(text, symbols, machine)
    p = lambda kind, *more, full=0: toxicity.pattern(kind, full, *more)
    plain = at("A fool here.")
    assert plain[p(toxicity.INSULT, 0, 0, 0)] == 1.0
    assert at("Loweish one")[p(toxicity.INSULT, 0, 0, 0)] == 0.8
    assert at("not a fool")[p(toxicity.INSULT, 1, 0, 0)] == 1.0
    assert at("not one of the very old fool")[p(toxicity.INSULT, 1, 0, 0)] == 0.0
    assert at("She wrote a fool came.")[p(toxicity.INSULT, 0, 1, 1)] == 1.0
    assert at('"a fool" came')[p(toxicity.INSULT, 0, 1, 0)] == 1.0
    assert at("fool, you.")[p(toxicity.INSULT, 0, 0, 1)] == 1.0
    assert at("I kill you")[p(toxicity.HARM, 0, 0, 1)] > 1.0
    for threat in ("I will kill you", "will all of them kill you", "ich werde dich umbringen", "je vais te tuer, toi"):
        assert at(threat)[p(toxicity.HARM, 0, 0, 1, full=1)] > 1.0, threat
    assert at("will one two three four kill you")[p(toxicity.HARM, 0, 0, 1)] > 1.0  # the intent is too far
    assert at("will it. kill you")[p(toxicity.HARM, 0, 0, 1, full=1)] == 0.0  # of another clause
    assert at("you are such a fool")[p(toxicity.INSULT, 0, 0, 1, full=1)] == 1.0
    assert at("you are not a fool")[p(toxicity.INSULT, 1, 0, 1, full=1)] == 1.0
    score = lambda t: toxicity.link(at(t), g.weights)
    assert score("fool fool fool you") > 0.5 > score("") == score(None)
    assert score("not a fool") < score("a fool")


def test_co_training_teaches_the_other_view():
    rng = np.random.default_rng(0)
    n = 1500
    y = (rng.random(n) < 0.8).astype(float)
    x = rng.standard_normal((n, quality.N_CONTENT + quality.N_META + 2))
    x[:, 1] += 4 * y
    x[:, quality.N_CONTENT + 3] += 4 * y
    x[:, -2:] = rng.integers(0, quality.GROUPS, (n, 2))
    lab = np.arange(n) < 300
    model = quality.co_train(x[lab], y[lab], x[600:], np.arange(300) % 4 == 0, quality.QualityParams())
    assert sum(map(sum, model.rounds)) > 50
    got = model.scores(x[300:600])[0] >= 0.5
    assert (got == y[300:600]).mean() > 0.95
    assert quality.row_features(None, None, None, float("nan"))[: quality.N_CONTENT] == [0.0] * quality.N_CONTENT


def test_pseudo_labels_grow_with_the_unlabelled_documents():
    rng = np.random.default_rng(1)
    n = 30_000
    y = (rng.random(n) < 0.8).astype(float)
    x = rng.standard_normal((n, quality.N_CONTENT + quality.N_META + 2))
    x[:, 1] += 4 * y
    x[:, quality.N_CONTENT + 3] += 4 * y
    x[:, -2:] = rng.integers(0, quality.GROUPS, (n, 2))
    model = quality.co_train(x[:300], y[:300], x[300:], np.arange(300) % 4 == 0, quality.QualityParams())
    assert sum(map(sum, model.rounds)) > 2 * 4 * 400
    assert quality.cut(np.array([5, 4, 2]), 4) == (1, 0.5)
    assert quality.cut(np.array([5, 4, 2]), 11) == (0, 1.0)
    assert quality.cut(np.array([0, 4, 0]), 1) == (1, 0.25)


def test_simhash_equals_counting_bits():
    import xxhash

    for text in (None, "", " \t\n", "One", "one two", "One two THREE four five one two three", "x " * 300, "ÀB c\x85d é"):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.simhash(text) & (2**64 - 1) == want


def test_archive_records_are_read_by_length():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    got = list(warc.parse(one + one))
    assert [r["block"] for r in got] == [block, block]
    assert list(warc.parse(b"")) == []
    for cut in (one[:20], one[:-2], one[1:]):
        with pytest.raises(ValueError):
            list(warc.parse(one + cut))


def test_fresh_names():
    assert fresh("key", ["a"]) == "key"
    assert fresh("key", ["KEY", "_key"]) == "__key"


def _by_hand(text, symbols):
    """The features of a text by looking back from every match, without any machine."""
    out = np.zeros(toxicity.N_FEATURES)
    tokens = toxicity.TOKENS.findall((text or "").lower())
    kinds = [(symbols[t] or (toxicity.OTHER, 0.0)) for t in tokens]
    ends = [i for i, (k, _) in enumerate(kinds) if k == toxicity.CLAUSE] + [len(kinds)]
    out[toxicity.ONE], out[toxicity.LENGTH] = 1.0, np.log1p(len(tokens))
    begin = 0
    for end in ends:
        clause = kinds[begin:end]
        aimed = any(k == toxicity.TARGET for k, _ in clause)
        for i, (kind, weight) in enumerate(clause):
            if kind not in (toxicity.INSULT, toxicity.HARM):
                continue
            before = [k for k, _ in clause[:i]]
            negated = toxicity.NEGATION in before[-toxicity.NEGATION_REACH :]
            quotes = [k for k, _ in kinds[: begin + i]].count(toxicity.QUOTE)
            last_quote = max((j for j, k in enumerate(before) if k == toxicity.QUOTE), default=-1)
            reported = quotes % 2 == 1 or toxicity.REPORT in before[last_quote + 1 :]
            left, full = 0, False
            start, reach = (
                (toxicity.INTENT, toxicity.INTENT_REACH) if kind == toxicity.HARM else (toxicity.TARGET, toxicity.DIRECT_REACH)
            )
            free = toxicity.TARGET if kind == toxicity.HARM else toxicity.INSULT
            for k in before:
                if k == start:
                    left = reach
                elif k == (toxicity.HARM if kind == toxicity.HARM else toxicity.REPORT):
                    left = 0
                elif k != free:
                    left = max(0, left - 1)
            full = left > 0
            out[toxicity.pattern(kind, full, negated, reported, aimed)] += weight / toxicity.SCALE
        begin = end + 1
    if tokens:
        out[toxicity.DENSITY] = 100 * out[: toxicity.N_PATTERNS].sum() / (len(tokens) + 50)
    return out


def test_toxicity_patterns_against_looking_back():
    r = random.Random(4)
    g = toxicity.Grammar(words={"fool": 5.0}, stems={"lowe": 4.0})
    words = 'fool loweish kill you they not never said will going one two three . ! " alpha beta'.split()
    for _ in range(1500):
        text = " ".join(r.choice(words) for _ in range(r.randrange(0, 40)))
        symbols = toxicity.Symbols(g)
        got = toxicity.features(text, symbols, toxicity.machine())
        assert np.allclose(got, _by_hand(text, symbols)), text


def test_texts_are_split_into_words_without_a_loop_over_words(monkeypatch):
    odd = [None, "", " ", " a  b\x1c\x85c\x0b\x0cD \xc9\xa0x\u2003y ", "a\x00b\tc\r\n", "x" * 90, "\n\n", "A \u212a I\u0307 z.", "q r"]
    texts = pa.array(["skipped", *odd])[1:]
    words, n = lm_scoring.split_words(texts)
    want = [ascii_words(t) for t in odd]
    assert words.cast(pa.binary()).to_pylist() == [w for t in want for w in t] and n.tolist() == [len(t) for t in want]
    assert lm_scoring.rare_classes(words).tolist() == [lm_scoring.rare_class(w) for t in want for w in t]
    assert lm_scoring.rare_classes(words[:0]).tolist() == []
    monkeypatch.setattr(lm_scoring, "CHUNK", 20)
    parts = list(lm_scoring.chunks(texts))
    assert [t for part in parts for t in part.to_pylist()] == odd and ["x" * 90] in [part.to_pylist() for part in parts]
    assert list(lm_scoring.chunks(texts[:0])) == []
    rnd = random.Random(5)
    long = [" ".join(f"Word{int(rnd.paretovariate(0.7))}" for _ in range(300)) for _ in range(1000)]

    def seconds(work):
        took = []
        for _ in range(5):
            begun = time.process_time()
            work()
            took.append(time.process_time() - begun)
        return min(took)

    def by_word():
        counts = Counter()
        for t in long:
            counts.update(ascii_words(t))
        return counts

    column = pa.array(long)
    got = lm_scoring.count_chunk(column)
    assert dict(zip((w.encode() for w in got["token"].to_pylist()), got["n"].to_pylist())) == by_word()
    assert seconds(lambda: lm_scoring.count_chunk(column)) < seconds(by_word)


def test_gates_are_contiguous():
    """Elementwise steps over slices of wider rows cost a fifth of the training time more."""
    p = lm_scoring.LmParams()
    matrix = np.random.default_rng(2).standard_normal((40, 3 * p.hidden)).astype(np.float32)
    gates = lm_scoring.by_gate(matrix, p.hidden)
    taken = gates.take(np.arange(9), axis=1)
    hidden = lm_scoring.by_gate(matrix[: p.hidden], p.hidden)
    state = np.zeros((9, p.hidden), np.float32)
    assert all((gates[k] == matrix[:, k * p.hidden : (k + 1) * p.hidden]).all() for k in range(3))
    assert taken.flags.c_contiguous and all(x.flags.c_contiguous for x in lm_scoring.gru_step(hidden, taken, state))
