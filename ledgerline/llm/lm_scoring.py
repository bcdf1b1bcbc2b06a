"""Language-model scores from a gated recurrent network, for whole documents.

The model is a gated recurrent unit over word ids, trained in numpy by
backpropagation truncated to windows of ``window`` steps, whose state runs on
from window to window. The output softmax is class-factored: P(word) =
P(class | state) * P(word | class, state). The ``vocab`` most frequent
training words are split into ``classes`` of equal square-root mass; every
other word falls into one of ``RARE`` classes by its surface, inside which it
has the smoothed share (c + 1) / (N_r + V_r + 1) of its class, c being its
training count. The one left over belongs to words never seen, so the scores
are a proper distribution over all texts.

How the work is spread:

- counts: every training document is counted in its task, split by Arrow
  functions ``CHUNK`` bytes at a time; partial counts meet in one aggregation,
  and the whole table of counts is written once.
- encoding: the ``hot`` most frequent counts travel to the tasks (at most
  ``hot`` entries, however large the corpus). One pass turns every document
  into ids, written once for training and scoring; every other word of a
  document joins the table of counts.
- weights: every training document is trained on once. It is dealt by hash of
  its row to one of two rounds, one in ``first`` to the first, and in turn to
  tasks of about ``task_tokens`` tokens, so their number follows the input. A
  task's updates are of ``streams`` parallel streams, fewer where it has few
  tokens. The tasks' weights, of fixed size, are averaged after each round in
  two steps on the executors, so that the driver gets one set of weights.
- scoring: documents of a batch run side by side, longest first, each with its
  own state from its first word to its end.

Defined cases: a null or empty text is one end token; a document whose words
were never seen still gets a score; without any training document the counts
are empty and each token costs log10(1 / (0 + 1)) = 0 in the base; repeated
rows and null ids give one result each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_dir

END = b""  # no word is empty
PIECE = 4096  # weights added up at a time
GROUPS = 64  # tasks whose weights are added up at once
ROWS = 4096  # logits computed at a time, so that they stay in the cache
CHUNK = 6_000_000  # bytes of text split into words at a time
RARE = 16  # classes of words outside the softmax vocabulary, by surface
LOG10 = float(np.log(10.0))


@dataclass(frozen=True)
class LmParams:
    vocab: int = 4096
    classes: int = 32
    hidden: int = 16
    window: int = 24
    streams: int = 384
    updates: int = 200  # of a task at least, before streams are added
    first: int = 8
    task_tokens: int = 2_000_000
    least_tokens: int = 100_000  # of a task, where there are few
    rate: float = 0.08
    hot: int = 262_144
    batch: int = 2048
    flush: int = 400_000
    seed: int = 7


# ------------------------------------------------------------------ counts


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive slices of about ``CHUNK`` bytes, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words (as ``ascii_words``) of all texts one behind another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # White space at an end of a text leaves an empty string there.
    empty = np.flatnonzero(pc.binary_length(words).to_numpy() == 0)
    if len(empty):
        n -= np.bincount(np.searchsorted(np.cumsum(n), empty, side="right"), minlength=len(n))
        words = words.filter(pc.not_equal(words, ""))
    return words, n


def count_chunk(texts: pa.Array) -> pa.Table:
    """(token, n) of the words of some texts; no word becomes a Python object."""
    met = split_words(texts)[0].dictionary_encode()
    n = np.bincount(met.indices.to_numpy(), minlength=len(met.dictionary))
    return pa.table({"token": met.dictionary, "n": pa.array(n, pa.int64())})


def count_words(texts: DataFrame, text: str, flush: int) -> DataFrame:
    """(token, n): how often each token occurs; the end of a text is the token ''."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        docs = 0

        def out():
            tokens = pa.concat_tables(held).group_by("token").aggregate([("n", "sum")])
            yield from tokens.select(["token", "n_sum"]).rename_columns(["token", "n"]).combine_chunks().to_batches()

        for batch in batches:
            docs += batch.num_rows
            for some in chunks(batch.column(0)):
                held.append(count_chunk(some))
                if sum(map(len, held)) > flush:
                    yield from out()
                    held.clear()
        if docs:
            held.append(pa.table({"token": pa.array([END.decode()], pa.string()), "n": pa.array([docs], pa.int64())}))
            yield from out()

    parts = texts.select(text).mapInArrow(partial, "token string, n long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def hot_counts(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The most frequent tokens with their counts, at most ``most`` of them.

    A histogram over log-spaced counts (a few hundred rows) gives the lowest
    count whose tokens all fit, so nothing is sorted and the driver gets no
    more than ``most`` rows and the end.
    """
    step = F.floor(F.log2(F.col("n")) * 16)
    bins = sorted(
        ((r["bin"], r["m"]) for r in counts.groupBy(step.alias("bin")).agg(F.count("*").alias("m")).collect()),
        reverse=True,
    )
    total, least = 0, None
    for b, m in bins:
        if total + m > most:
            break
        total, least = total + m, b
    # The end is always among them, however rare.
    chosen = F.col("token") == ""
    if least is not None:
        chosen = chosen | (step >= F.lit(least))
    rows = counts.filter(chosen).select("token", "n").toArrow()
    return dict(zip((t.encode() for t in rows.column(0).to_pylist()), rows.column(1).to_pylist()))


# ------------------------------------------------------------------ vocabulary


def _endings() -> list[int]:
    """A kind for each last byte of a word."""
    kinds = [7] * 256
    groups = (range(97, 123), range(128, 256), b".", b",", range(48, 58), b"!?;:", b"%$&*#|")
    for kind, group in enumerate(groups):
        for last in group:
            kinds[last] = kind
    return kinds


ENDINGS = _endings()


def rare_class(word: bytes) -> int:
    """0..RARE-1 by surface: what the word ends in, and whether it is all ASCII."""
    return ENDINGS[word[-1]] * 2 + (not word.isascii())


def rare_classes(words: pa.Array) -> np.ndarray:
    """``rare_class`` of each of many words; none is empty."""
    last = np.frombuffer(pc.binary_slice(words.cast(pa.binary()), -1).buffers()[2] or b"", np.uint8, len(words))
    return np.array(ENDINGS)[last] * 2 + pc.invert(pc.string_is_ascii(words)).to_numpy(zero_copy_only=False)


@dataclass
class Vocabulary:
    """What the tasks need of the counts; its size is bounded by the parameters."""

    ids: dict[bytes, int]  # softmax words; the end is 0 where there is one
    starts: np.ndarray  # first id of each class, and the number of ids
    unigram: np.ndarray  # training counts by id
    rare_tokens: np.ndarray  # N_r by rare class
    rare_types: np.ndarray  # V_r by rare class

    @property
    def size(self) -> int:
        return len(self.unigram)

    def index(self, hot: dict[bytes, int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The hot words, and by their places the id and log10(c + 1); the last entry is for others."""
        ids = [self.ids[w] if w in self.ids else self.size + rare_class(w) for w in hot]
        logs = np.log10(np.array([*hot.values(), 0], dtype=np.float64) + 1)
        return pa.array(list(hot), pa.binary()).cast(pa.string()), np.array([*ids, -1], np.int32), logs

    @property
    def classes(self) -> int:
        return len(self.starts) - 1


def build_vocabulary(hot: dict[bytes, int], rare: list[tuple[int, int, int]], p: LmParams) -> Vocabulary:
    """``rare``: (class, tokens, types) of all words by surface, from the whole counts."""
    words = sorted((w for w in hot if w != END), key=lambda w: (-hot[w], w))[: p.vocab - 1]
    words = ([END] if END in hot else []) + words
    n = np.array([hot[w] for w in words], dtype=np.float64)
    mass = np.cumsum(np.sqrt(n))
    k = np.minimum((mass / mass[-1] * p.classes).astype(int), p.classes - 1) if len(words) else np.zeros(0, int)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(k)) + 1, [len(words)]]) if len(words) else np.array([0])
    tokens, types = np.zeros(RARE), np.zeros(RARE)
    for r, t, v in rare:
        tokens[r], types[r] = t, v
    for w in words:
        if w != END:
            tokens[rare_class(w)] -= hot[w]
            types[rare_class(w)] -= 1
    return Vocabulary({w: i for i, w in enumerate(words)}, starts, n, tokens, types)


def rare_totals(counts: DataFrame) -> list[tuple[int, int, int]]:
    """(class, tokens, types) over the whole table of counts, end excluded."""

    def partial(batches):
        tokens, types = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
        for b in batches:
            b = b.filter(pc.not_equal(b.column(0), ""))
            kinds = rare_classes(b.column(0))
            np.add.at(tokens, kinds, b.column(1).to_numpy())
            types += np.bincount(kinds, minlength=RARE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(RARE), pa.int32()), pa.array(tokens), pa.array(types)], names=["r", "t", "v"]
        )

    parts = counts.select("token", "n").mapInArrow(partial, "r int, t long, v long")
    return [tuple(x) for x in parts.groupBy("r").agg(F.sum("t"), F.sum("v")).collect()]


# ------------------------------------------------------------------ model


def new_weights(v: Vocabulary, p: LmParams) -> dict[str, np.ndarray]:
    """Small random weights; the output biases start as the training frequencies."""
    rng = np.random.default_rng(p.seed)
    h, inputs, outs = p.hidden, v.size + RARE, v.classes + RARE
    size = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
    by_class = np.concatenate(
        [np.add.reduceat(v.unigram, v.starts[:-1]) if v.size else np.zeros(0), np.maximum(v.rare_tokens, 0)]
    )
    return {
        "x": size(inputs, 3 * h),  # input word -> gates
        "h": size(h, 3 * h),
        "b": np.zeros(3 * h, np.float32),
        # State -> class, and state -> word of a class; the last row or column is the bias.
        "c": np.vstack([size(h, outs), np.log((by_class + 0.5) / (by_class + 0.5).sum()).astype(np.float32)]),
        "w": np.column_stack(
            [size(v.size, h), np.log((v.unigram + 0.5) / max(v.unigram.sum(), 1)).astype(np.float32)]
        ),
    }


def _sigmoid(x):
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def by_gate(matrix, h):
    """(rows, 3 h) -> (3, rows, h), so that each gate's share is contiguous."""
    return np.ascontiguousarray(matrix.reshape(-1, 3, h).transpose(1, 0, 2))


def gru_step(hidden, gates, state):
    """One step for a batch: the input words' share of the gates and states -> gates and new states.

    ``hidden`` and ``gates`` are by gate (see ``by_gate``); ``gates`` is overwritten.
    """
    ha = state @ hidden
    rz, hn = gates[:2], ha[2]
    rz += ha[:2]
    r, z = _sigmoid(rz)
    n = r * hn
    n += gates[2]
    np.tanh(n, out=n)
    new = state - n
    new *= z
    new += n
    return r, z, n, hn, new


def _softmax(states, matrix, rows, chosen):
    """exp of the logits, their sums, and the logits chosen; ``states`` end in a one, ``matrix`` in the biases.

    Biases are log shares and states lie within (-1, 1), so exp is far from
    its limits; only where it is not, the largest logit is taken off first.
    """
    logits = states @ matrix
    own = logits[rows, chosen]
    e = np.exp(logits, out=logits)
    total = e @ np.ones(e.shape[1], e.dtype)
    if not (np.isfinite(total).all() and total.all()):
        logits = states @ matrix
        logits -= logits.max(axis=1, keepdims=True)
        own = logits[rows, chosen]
        e = np.exp(logits)
        total = e.sum(axis=1)
    return e, total, own


def class_of(starts: np.ndarray, outs: int) -> np.ndarray:
    """The class of each target id: a word's, or one of its own for each rare class."""
    classes = len(starts) - 1
    return np.concatenate([np.repeat(np.arange(classes), np.diff(starts)), np.arange(classes, outs)]).astype(np.int16)


def output_losses(weights, starts, states, target, grads=None):
    """-ln P of each target id, given the states (with a one behind each).

    A target is a word id, or ``size + r`` for the rare class r. With
    ``grads`` (a dict of arrays) the gradients of the sum are added there, and
    the gradient by the states is returned too.
    """
    classes = len(starts) - 1
    # By class, so that the words of a class are one slice.
    cls = class_of(starts, weights["c"].shape[1])[target]
    order = np.argsort(cls, kind="stable")
    cls, target, states = cls[order], target[order], states[order]
    loss = np.empty(len(target), states.dtype)
    back = None if grads is None else np.empty((len(target), states.shape[1] - 1), states.dtype)
    inner = weights["c"][:-1].T
    for lo in range(0, len(target), ROWS):
        at = slice(lo, min(lo + ROWS, len(target)))
        rows = np.arange(at.stop - lo)
        e, total, own = _softmax(states[at], weights["c"], rows, cls[at])
        loss[at] = np.log(total) - own
        if grads is not None:
            e *= np.reciprocal(total)[:, None]
            e[rows, cls[at]] -= 1
            grads["c"] += states[at].T @ e
            np.matmul(e, inner, out=back[at])
    edges = np.searchsorted(cls, np.arange(classes + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        lo, hi = int(starts[k]), int(starts[k + 1])
        if hi - lo == 1:
            continue
        at = slice(int(edges[k]), int(edges[k + 1]))
        s, w = states[at], weights["w"][lo:hi]
        rows, word = np.arange(len(s)), target[at] - lo
        e, total, own = _softmax(s, w.T, rows, word)
        loss[at] += np.log(total) - own
        if grads is not None:
            e *= np.reciprocal(total)[:, None]
            e[rows, word] -= 1
            grads["w"][lo:hi] += e.T @ s
            back[at] += e @ w[:, :-1]
    out = np.empty_like(loss)
    out[order] = loss
    if back is None:
        return out, None
    unsorted = np.empty_like(back)
    unsorted[order] = back
    return out, unsorted


def _sum_by_word(words, rows):
    """The distinct words and the sums of their rows."""
    order = np.argsort(words, kind="stable")
    words = words[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    return words[first], np.add.reduceat(rows[order], first, axis=0)


def train_window(weights, starts, words, targets, state):
    """Loss sum, gradients and last state of one window (time x streams).

    The state is set to zero where the input word is the end of a text (id 0).
    The gradient of the input words is a pair: the distinct words, their rows.
    """
    steps, width = words.shape
    h, kind = state.shape[1], state.dtype
    ended = [np.flatnonzero(w == 0) for w in words]
    hidden, inputs = by_gate(weights["h"], h), by_gate(weights["x"] + weights["b"], h)
    kept = []
    states = np.empty((steps, width, h + 1), kind)
    states[:, :, h] = 1
    for t in range(steps):
        if len(ended[t]):
            state = state.copy()
            state[ended[t]] = 0
        r, z, n, hn, new = gru_step(hidden, inputs.take(words[t], axis=1), state)
        kept.append((state, r, z, n, hn))
        states[t, :, :h] = state = new
    grads = {k: np.zeros_like(v) for k, v in weights.items() if k != "x"}
    loss, back = output_losses(weights, starts, states.reshape(-1, h + 1), targets.reshape(-1), grads)
    back = back.reshape(steps, width, h)
    carry = np.zeros((width, h), kind)
    olds = np.empty((steps, width, h), kind)
    dxs, dhs = np.empty((steps, width, 3 * h), kind), np.empty((steps, width, 3 * h), kind)
    turned = np.ascontiguousarray(weights["h"].T)
    for t in range(steps - 1, -1, -1):
        old, r, z, n, hn = kept[t]
        olds[t] = old
        dx, dh = dxs[t], dhs[t]
        d = back[t]
        d += carry
        dz = d * z  # of the old state, through the update gate
        dn = d - dz
        dn *= 1 - n * n
        carry = dz.copy()
        dz *= old - n
        dz *= 1 - z
        dr = dn * hn
        dr *= r * (1 - r)
        dx[:, :h], dx[:, h : 2 * h], dx[:, 2 * h :] = dr, dz, dn
        dh[:, :h], dh[:, h : 2 * h] = dr, dz
        np.multiply(dn, r, out=dh[:, 2 * h :])
        carry += dh @ turned
        carry[ended[t]] = 0
    flat = dxs.reshape(-1, 3 * h)
    grads["h"] += olds.reshape(-1, h).T @ dhs.reshape(-1, 3 * h)
    grads["b"] += flat.sum(axis=0)
    grads["x"] = _sum_by_word(words.reshape(-1), flat)
    return float(loss.sum()), grads, state


def fit(weights, starts, docs: list[np.ndarray], p: LmParams):
    """One pass over documents (ids, the end last) in parallel streams; the tokens seen."""
    kind = docs[0].dtype
    stream = np.concatenate([np.zeros(1, kind), *docs])
    width = min(p.streams, max(8, len(stream) // (p.window * p.updates)), (len(stream) - 1) // p.window)
    width = max(1, width)
    steps = (len(stream) - 1) // width
    words = stream[: steps * width].reshape(width, steps).T
    targets = stream[1 : steps * width + 1].reshape(width, steps).T
    state = np.zeros((width, p.hidden), np.float32)
    seen = {k: np.full_like(v, 1e-6) for k, v in weights.items()}
    for t in range(0, steps, p.window):
        w, y = words[t : t + p.window], targets[t : t + p.window]
        _, grads, state = train_window(weights, starts, w, y.astype(np.int64), state)
        scale = np.float32(w.size**-0.5)
        for k, g in grads.items():
            at, g = g if k == "x" else (slice(None), g)  # other inputs have no gradient
            g *= scale
            past = seen[k][at] + g * g
            seen[k][at] = past
            g *= p.rate / np.sqrt(past)
            weights[k][at] -= g
    return steps * width


def id_type(v: Vocabulary):
    return np.uint16 if v.size + RARE <= 1 << 16 else np.int32


def _mean(batch: pa.Table, keys: list[str]) -> pa.Table:
    """The mean of pieces of weights, weighted by their tokens."""
    counts = batch.column("n").to_pylist()
    total, mean = sum(counts), 0.0
    for n, piece in zip(counts, batch.column("piece").to_pylist()):
        mean = mean + np.frombuffer(piece, np.float64) * (n / total)
    return pa.table(
        {k: batch.column(k).slice(0, 1) for k in keys}
        | {"n": pa.array([total], pa.int64()), "piece": pa.array([mean.tobytes()], pa.binary())}
    )


def train(encoded: DataFrame, v: Vocabulary, p: LmParams) -> dict[str, np.ndarray]:
    """Weights trained on ``encoded``: row, n (tokens) and ids (as bytes of ``id_type``) of training documents.

    ``encoded`` is read several times, so it should be a stored table.
    """
    weights, kind = new_weights(v, p), id_type(v)
    if not v.size or END not in v.ids:
        return weights
    spark = encoded.sparkSession
    names, shapes = list(weights), {k: w.shape for k, w in weights.items()}
    part = F.pmod(F.xxhash64("row"), F.lit(p.first)) == 0
    for now in (part, ~part):
        chosen = encoded.filter(now)
        tokens = chosen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not tokens:
            continue
        tasks = max(1, -(-tokens // p.task_tokens), min(8, tokens // p.least_tokens))
        shared = spark.sparkContext.broadcast((weights, v.starts))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, starts = shared.value
            own = {k: w.copy() for k, w in start.items()}
            tokens, docs, held = 0, [], 0
            for b in batches:
                for t in b.column(0):
                    docs.append(np.frombuffer(t.as_py(), kind))
                    held += len(docs[-1])
                    if held > p.task_tokens:  # bounds the memory of a task
                        tokens += fit(own, starts, docs, p)
                        docs, held = [], 0
            if held:
                tokens += fit(own, starts, docs, p)
            if tokens:
                flat = np.concatenate([own[k].reshape(-1) for k in names]).astype(np.float64)
                at = range(0, len(flat), PIECE)
                group = TaskContext.get().partitionId() // GROUPS
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at, pa.int64()),
                        pa.array([group] * len(at), pa.int64()),
                        pa.array([tokens] * len(at), pa.int64()),
                        pa.array([flat[i : i + PIECE].tobytes() for i in at], pa.binary()),
                    ],
                    names=["at", "team", "n", "piece"],
                )

        # Dealt in turn, so that copies of one text don't meet in one task.
        pieces = chosen.select("ids").repartition(tasks).mapInArrow(work, "at long, team long, n long, piece binary")
        if tasks > GROUPS:
            pieces = pieces.groupBy("at", "team").applyInArrow(
                lambda t: _mean(t, ["at", "team"]), "at long, team long, n long, piece binary"
            )
        rows = pieces.groupBy("at").applyInArrow(lambda t: _mean(t, ["at"]), "at long, n long, piece binary").collect()
        shared.unpersist()
        mean = np.concatenate([np.frombuffer(r["piece"], np.float64) for r in sorted(rows, key=lambda r: r["at"])])
        at = 0
        for k in names:
            size = int(np.prod(shapes[k]))
            weights[k] = mean[at : at + size].reshape(shapes[k]).astype(np.float32)
            at += size
    return weights


def score_batch(weights, starts, docs: list[np.ndarray], p: LmParams) -> np.ndarray:
    """log10 P of each document (ids), rare words counted as their class only."""
    scores, h = np.zeros(len(docs)), p.hidden
    order = np.argsort([-len(d) for d in docs], kind="stable")
    hidden, inputs = by_gate(weights["h"], h), by_gate(weights["x"] + weights["b"], h)
    for lo in range(0, len(docs), p.batch):
        part = order[lo : lo + p.batch]
        lengths = np.array([len(docs[i]) for i in part])
        state = np.zeros((len(part), h), np.float32)
        last = np.zeros(len(part), np.int64)  # a text starts as if an end came before it
        flat = np.concatenate([docs[i] for i in part])
        start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # documents longer than a step's number
        for t in range(0, len(alive), p.window):
            live = alive[t : t + p.window]
            ends = np.concatenate([[0], np.cumsum(live)])
            states = np.empty((ends[-1], h + 1), np.float32)
            states[:, h] = 1
            targets = np.empty(ends[-1], np.int64)
            who = np.empty(ends[-1], np.int64)
            for s, n in enumerate(live.tolist()):
                at = slice(ends[s], ends[s + 1])
                state = gru_step(hidden, inputs.take(last[:n], axis=1), state[:n])[4]
                states[at, :h] = state
                last = targets[at] = flat[start[:n] + (t + s)]
                who[at] = part[:n]
            loss, _ = output_losses(weights, starts, states, targets)
            scores -= np.bincount(who, weights=loss, minlength=len(docs))
    return scores / LOG10


# ------------------------------------------------------------------ scoring


def score_documents(
    docs: DataFrame, text: str, training: Column, params: LmParams = LmParams()
) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` says which rows the model may learn from. The columns of
    ``docs`` are returned as they are; a column called like one of the new ones
    is replaced.
    """
    p, spark = params, docs.sparkSession
    root = shared_dir(spark, "lm")
    may_learn = F.coalesce(training, F.lit(False))
    learn = docs.filter(may_learn).select(F.col(text).alias("t"))
    count_words(learn, "t", p.flush).write.parquet(f"{root}/counts")
    counts = spark.read.schema("token string, n long").parquet(f"{root}/counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = hot_counts(counts, p.hot)
    vocabulary = build_vocabulary(hot, rare_totals(counts), p)
    size, kind = vocabulary.size, id_type(vocabulary)
    # Broadcasts hold arrays only: they are pickled by reference to their classes.
    known_words = spark.sparkContext.broadcast(vocabulary.index(hot))
    end = list(hot).index(END) if END in hot else None
    base = float(np.log10(n + v + 1))
    rare_base = np.log10(np.maximum(vocabulary.rare_tokens + vocabulary.rare_types, 0) + 1)

    # Per document: sums over hot tokens; its other words go on to the join.
    # A rare word's part is log10(c + 1), less what does not depend on c.
    shape = "n long, known long, base double, part double, words array<string>, times array<int>, ids binary"

    def encode_chunk(texts: pa.Array) -> pa.Array:
        words, id_of, log_of = known_words.value
        tokens, n = split_words(texts)
        docs, other = len(n), len(words)
        doc = np.repeat(np.arange(docs, dtype=np.int32), n)
        at = pc.fill_null(pc.index_in(tokens, words), other).to_numpy()
        own, missed = id_of[at], at == other
        names = tokens.filter(pa.array(missed))
        own[missed] = size + rare_classes(names)
        rare = own >= size
        part = np.zeros(docs)
        if size:
            part = np.bincount(doc[rare], weights=log_of[at[rare]] - rare_base[own[rare] - size], minlength=docs)
        total = np.bincount(doc, weights=log_of[at], minlength=docs) + (0.0 if end is None else log_of[end])
        known = n - np.bincount(doc[missed], minlength=docs) + (end is not None)
        # A document's other words, each once with how often it occurs.
        names = names.dictionary_encode()
        width = max(len(names.dictionary), 1)
        pairs, times = np.unique(doc[missed].astype(np.int64) * width + names.indices.to_numpy(), return_counts=True)
        offsets = pa.array(np.searchsorted(pairs, np.arange(docs + 1) * width), pa.int32())
        # The end, id 0, follows the words of each document.
        edges = np.concatenate([[0], np.cumsum(n + 1)])
        ids, inside = np.zeros(edges[-1], kind), np.ones(edges[-1], bool)
        inside[edges[1:] - 1] = False
        ids[inside] = own
        buffers = [None, pa.py_buffer((edges * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)]
        return pa.StructArray.from_arrays(
            [
                pa.array(n + 1, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(total - base * (n + 1), pa.float64()),
                pa.array(part, pa.float64()),
                pa.ListArray.from_arrays(offsets, names.dictionary.take(pa.array(pairs % width))),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                pa.Array.from_buffers(pa.binary(), docs, buffers),
            ],
            names=["n", "known", "base", "part", "words", "times", "ids"],
        )

    @F.arrow_udf(shape)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([encode_chunk(some) for some in chunks(batch)] or [encode_chunk(batch)])

    mine = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keep = [c for c in docs.columns if c.lower() not in mine and c != text]
    one = docs.select(
        F.struct(*keep).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        may_learn.alias("learn"),
        encode(F.col(text)).alias("s"),
    )
    one.write.parquet(f"{root}/encoded")
    one = spark.read.schema(one.schema).parquet(f"{root}/encoded")
    weights = train(one.filter("learn").select("row", "s.n", "s.ids"), vocabulary, p)
    model = spark.sparkContext.broadcast((weights, vocabulary.starts))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, starts = model.value
        for batch in batches:
            ids = [np.frombuffer(x.as_py(), kind) for x in batch]
            yield pa.array(score_batch(w, starts, ids, p) if size else np.zeros(len(ids)))

    words = one.select("row", F.explode(F.arrays_zip("s.words", "s.times")).alias("w")).select(
        "row", F.col("w.words").alias("token"), F.col("w.times").alias("k")
    )
    extra = (
        words.join(counts, "token", "left")
        .select("row", "k", F.col("n"), F.log10(F.coalesce("n", F.lit(0)) + 1.0).alias("l"))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("known"),
            F.sum(F.col("k") * F.col("l")).alias("l"),
        )
    )
    scored = one.select("doc", "row", "s.n", F.col("s.known").alias("hot"), "s.base", "s.part", score("s.ids").alias("p"))
    zero = F.lit(0.0)
    return scored.join(extra, "row", "left").select(
        "doc.*",
        F.col("n").alias("n_tokens"),
        (F.col("hot") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("l", zero)).alias("base_score"),
        (F.col("p") + F.col("part") + F.coalesce("l", zero)).alias("score"),
    )
