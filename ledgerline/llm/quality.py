"""Quality by co-training two views of a document.

The content view sees the words of a text (repetition, variety, lengths,
spelling), the metadata view its record and layout (language, source, length,
lines, kinds of characters). Each view is a logistic regression over
quantile bins of its features. In every round each view labels the unlabelled
documents it is sure of, and the *other* view learns from them; a round takes
as many of each class as keeps the classes' shares, at most ``take`` or the
share ``take_share`` of the unlabelled documents, the surest first. At the end each view is
calibrated on labelled documents neither has learned from, and the
calibrated log-odds are combined into one score.

How the work is spread: at most ``labelled`` labelled documents reach the
driver, as features (a few numbers each); the bins come from them. Every
unlabelled document takes part: its bins (a byte each) are written once, and
each round scores all of them. What the driver gets are histograms of the
log-odds, for the cuts, and sums of gradients and second derivatives, for the
fits, whose sizes don't depend on the input. Which document was given when
follows from the cuts so far, so no state is kept; at a cut, documents go by
hash of their id. Every document is scored whole, in one pass without a shuffle.

Defined cases: a null or empty text has no words and features of zero; null
metadata is a value of its own; without labels of both kinds every score is
0.5; repeated rows get equal scores; unknown languages and sources fall into
hashed groups.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_mod
from ledgerline.llm.sampling import labelled
from ledgerline.session import shared_dir

N_CONTENT, N_META, GROUPS = 9, 10, 16
STEPS, TOP = 64, 60  # steps of the histograms per unit of log-odds, and their end


@dataclass(frozen=True)
class QualityParams:
    labelled: int = 12_000
    rounds: int = 4
    sure: float = 0.95
    take: int = 400  # pseudo-labels a view gives in a round, at most,
    take_share: float = 0.05  # or so many per unlabelled document, if that is more
    bins: int = 8
    ridge: float = 1.0


def content_features(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_CONTENT
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    letters = sum(map(str.isalpha, counts))
    return [
        np.log1p(n),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        letters / len(counts),
        sum(map(str.isupper, counts)) / len(counts),
    ]


def metadata_features(text: str, n_chars: float | None) -> list[float]:
    n = len(text)
    if not n:
        return [np.log1p(n_chars or 0.0), *[0.0] * (N_META - 1)]
    counts = Counter(text)
    share = lambda test: sum(k for c, k in counts.items() if test(c)) / n
    lines = counts["\n"] + 1
    return [
        np.log1p(n if n_chars is None else max(n_chars, 0.0)),
        np.log1p(lines),
        np.log1p(n / lines),
        share(str.isupper),
        share(str.isdigit),
        share(str.isspace),
        share(lambda c: not (c.isalnum() or c.isspace())),
        (counts["."] + counts[","]) / n,
        counts["!"] / n,
        sum(1 for c in counts if ord(c) > 127) / len(counts),
    ]


def group(value: str | None, salt: str) -> int:
    return zlib.crc32(f"{salt}{value if value is not None else chr(0)}".encode()) % GROUPS


def feature_column(text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """array<double>: content features, metadata features, language group, source group."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, langs, sources, sizes in batches:
            rows = [row_features(*r) for r in zip(texts, langs, sources, sizes)]
            yield pd.Series(rows, index=texts.index, dtype=object)

    return run(text, lang, source, n_chars)


def row_features(text, lang, source, n_chars) -> list[float]:
    text = text or ""
    size = None if n_chars is None or n_chars != n_chars else float(n_chars)
    return [
        *content_features(text),
        *metadata_features(text, size),
        float(group(lang, "l")),
        float(group(source, "s")),
    ]


# ------------------------------------------------------------------ views


class View:
    """Logistic regression over quantile bins of some columns, and groups of others."""

    def __init__(self, columns: list[int], groups: list[int], x: np.ndarray, p: QualityParams):
        self.columns, self.groups, self.ridge = columns, groups, p.ridge
        cuts = np.linspace(0, 1, p.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, c], cuts)) for c in columns]
        self.weights = None

        sizes = [*[len(e) + 1 for e in self.edges], *[GROUPS] * len(groups)]
        self.starts = 1 + np.cumsum([0, *sizes])  # the first place is the constant's

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The bin or group of each column, a byte each."""
        bins = [np.searchsorted(e, x[:, c], side="right") for c, e in zip(self.columns, self.edges)]
        return np.column_stack([*bins, *[x[:, c] for c in self.groups]]).astype(np.uint8)

    def design(self, codes: np.ndarray) -> np.ndarray:
        d = np.zeros((len(codes), self.starts[-1]))
        d[:, 0] = 1
        d[np.arange(len(codes))[:, None], self.starts[:-1] + codes] = 1
        return d

    def log_odds(self, codes: np.ndarray) -> np.ndarray:
        return self.weights[0] + self.weights[self.starts[:-1] + codes].sum(axis=1)


def slopes(d: np.ndarray, y: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and second derivatives of the logistic loss, summed over rows."""
    p = 1 / (1 + np.exp(-np.clip(d @ beta, -30, 30)))
    return d.T @ (p - y), (d * (p * (1 - p) + 1e-9)[:, None]).T @ d


def newton(betas: list[np.ndarray], sums, ridge: float) -> list[np.ndarray]:
    """Fits by Newton's method, side by side; ``sums(betas)`` gives the slopes of each."""
    betas = [b.copy() for b in betas]
    for _ in range(30):
        largest = 0.0
        for beta, (grad, hess) in zip(betas, sums(betas)):
            keep = np.full(len(beta), ridge)
            keep[0] = 1e-6  # the constant is free
            step = np.linalg.solve(hess + np.diag(keep), grad + keep * beta)
            beta -= np.clip(step, -3, 3)
            largest = max(largest, np.abs(step).max())
        if largest < 1e-6:
            break
    return betas


def logistic(d: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    return newton([np.zeros(d.shape[1])], lambda b: [slopes(d, y, b[0])], ridge)[0]


# ------------------------------------------------------------------ the unlabelled documents


@dataclass
class Round:
    """What a round gave: the views' weights then, and by view and class the cut."""

    weights: list[np.ndarray]
    cuts: list[tuple[tuple[int, float], tuple[int, float]]]  # (step, share of documents on it): positive, negative


def _steps(odds: np.ndarray) -> np.ndarray:
    return np.floor(np.minimum(np.abs(odds), TOP) * STEPS).astype(np.int64)


def given(views: list[View], rounds: list[Round], codes: np.ndarray, u: np.ndarray, edge: float):
    """(free, [(rows, labels) given by each view]): what became of these documents.

    ``u``: a number in [0, 1) by hash of the id.
    """
    own = _split(views, codes)
    free, out = np.ones(len(codes), bool), [[], []]
    for past in rounds:
        taken = np.zeros(len(codes), bool)
        for i, v in enumerate(views):
            odds = past.weights[i][0] + past.weights[i][v.starts[:-1] + own[i]].sum(axis=1)
            step = _steps(odds)
            for sign, (at, share) in zip((1, -1), past.cuts[i]):
                mine = free & (sign * odds > edge) & ((step > at) | ((step == at) & (u < share)))
                out[i].append((np.flatnonzero(mine), sign > 0))
                taken |= mine
        free &= ~taken
    joined = []
    for parts in out:
        rows = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in parts]])
        joined.append((rows, np.concatenate([np.zeros(0), *[np.full(len(r), float(k)) for r, k in parts]])))
    return free, joined


def _split(views: list[View], codes: np.ndarray) -> list[np.ndarray]:
    n = len(views[0].starts) - 1
    return [codes[:, :n], codes[:, n:]]


def histograms(views: list[View], rounds: list[Round], codes: np.ndarray, u: np.ndarray, edge: float) -> np.ndarray:
    """By view and class the free documents that the view is sure of, by step of their log-odds; flat."""
    free, _ = given(views, rounds, codes, u, edge)
    out = np.zeros((2, 2, TOP * STEPS + 1))
    for i, (v, own) in enumerate(zip(views, _split(views, codes))):
        odds = v.log_odds(own)
        for k, sign in enumerate((1, -1)):
            out[i, k] = np.bincount(_steps(odds[free & (sign * odds > edge)]), minlength=out.shape[2])
    return out.reshape(-1)


def pseudo_slopes(views, rounds, codes, u, edge, betas) -> np.ndarray:
    """Slopes of both views over the documents given to them; flat."""
    _, by = given(views, rounds, codes, u, edge)
    out = []
    for i, (v, own) in enumerate(zip(views, _split(views, codes))):
        rows, y = by[1 - i]  # a view learns from the other one
        out += [x.reshape(-1) for x in slopes(v.design(own[rows]), y, betas[i])]
    return np.concatenate(out)


class Pool:
    """Unlabelled documents in memory."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.u = (np.arange(len(codes)) * 0.6180339887498949) % 1

    def __len__(self) -> int:
        return len(self.codes)

    def sum(self, f) -> np.ndarray:
        """The sum of ``f(codes, u)``, an array of fixed size."""
        return f(self.codes, self.u)


class StoredPool:
    """Unlabelled documents in a table (codes binary, u double)."""

    def __init__(self, rows: DataFrame):
        self.rows, self.n = rows, rows.count()

    def __len__(self) -> int:
        return self.n

    def sum(self, f) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if b.num_rows:
                    codes = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                    part = f(codes, b.column(1).to_numpy(zero_copy_only=False))
                    total = part if total is None else total + part
            if total is not None:
                at = np.append(np.flatnonzero(total[:-1]), len(total) - 1)  # the last one tells the size
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "v"])

        parts = self.rows.mapInArrow(run, "at long, v double")
        rows = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        at = rows.column(0).to_numpy()
        out = np.zeros(at.max() + 1)
        out[at] = rows.column(1).to_numpy()
        return out


def cut(counts: np.ndarray, most: float) -> tuple[int, float]:
    """(step, share of it) from which the surest ``most`` are taken."""
    above = np.cumsum(counts[::-1])[::-1] - counts
    at = int(np.argmax(above + counts <= most)) if (above + counts <= most).any() else len(counts)
    if at == 0:
        return 0, 1.0
    at -= 1  # of this step only a part
    return at, float((most - above[at]) / counts[at])


@dataclass
class Model:
    content: View
    meta: View
    calibrate: np.ndarray  # (content, metadata) x (scale, shift)
    combine: np.ndarray  # constant, content, metadata
    rounds: list[tuple[int, int]]  # pseudo-labels given by (content, metadata)

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, content score, metadata score)."""
        own = [v.log_odds(v.codes(x)) * s + t for v, (s, t) in zip((self.content, self.meta), self.calibrate)]
        both = self.combine[0] + self.combine[1] * own[0] + self.combine[2] * own[1]
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return sigmoid(both), sigmoid(own[0]), sigmoid(own[1])


def make_views(x: np.ndarray, p: QualityParams) -> list[View]:
    meta = list(range(N_CONTENT, N_CONTENT + N_META))
    return [
        View(list(range(N_CONTENT)), [], x, p),
        View(meta, [N_CONTENT + N_META, N_CONTENT + N_META + 1], x, p),
    ]


def all_codes(views: list[View], x: np.ndarray) -> np.ndarray:
    return np.hstack([v.codes(x) for v in views])


def co_train(
    x: np.ndarray,
    y: np.ndarray,
    pool: np.ndarray | StoredPool,
    held: np.ndarray,
    p: QualityParams,
    views: list[View] | None = None,
) -> Model:
    """``held``: labelled rows kept for calibration; ``pool``: features, or a stored pool with its ``views``."""
    views = views or make_views(x, p)
    if isinstance(pool, np.ndarray):
        pool = Pool(all_codes(views, pool))
    designs = [v.design(v.codes(x[~held])) for v in views]
    rounds, counts, good = [], [], float(y[~held].mean())
    edge = np.log(p.sure / (1 - p.sure))

    def fit() -> None:
        past = list(rounds)

        def sums(betas):
            own = [slopes(d, y[~held], b) for d, b in zip(designs, betas)]
            if past and len(pool):
                flat, at = pool.sum(lambda c, u: pseudo_slopes(views, past, c, u, edge, betas)), 0
                for grad, hess in own:
                    for a in (grad, hess):
                        a += flat[at : at + a.size].reshape(a.shape)
                        at += a.size
            return own

        starts = [np.zeros(d.shape[1]) if v.weights is None else v.weights for v, d in zip(views, designs)]
        for v, beta in zip(views, newton(starts, sums, p.ridge)):
            v.weights = beta

    fit()
    for _ in range(p.rounds):
        if not len(pool):
            break
        past = list(rounds)
        sure = pool.sum(lambda c, u: histograms(views, past, c, u, edge)).reshape(2, 2, -1)
        take = max(p.take, p.take_share * len(pool))
        most = [np.ceil(take * share) for share in (good, 1 - good)]
        counts.append(tuple(int(sum(min(h.sum(), m) for h, m in zip(own, most))) for own in sure))
        if not any(counts[-1]):
            break
        rounds.append(Round([v.weights for v in views], [tuple(map(cut, own, most)) for own in sure]))
        fit()
    odds = [v.log_odds(v.codes(x[held])) for v in views]
    line = lambda z: np.column_stack([np.ones(len(z)), z])
    fits = [logistic(line(z), y[held], 0.1) for z in odds]
    calibrate = np.array([(f[1], f[0]) for f in fits])
    own = [z * s + t for z, (s, t) in zip(odds, calibrate)]
    combine = logistic(np.column_stack([np.ones(len(own[0])), *own]), y[held], 0.1)
    return Model(*views, calibrate, combine, counts)


def train(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> Model | None:
    """Learn from labelled rows whose crc32(doc_id as text) mod 5 is not 0; None without both classes."""
    p = params
    columns = docs.select("doc_id", "text", "lang", "source", "n_chars")
    x_of = feature_column(F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars"))
    rows = (
        labelled(columns, labels, "quality", id_mod(F.col("l_id"), 5) != 0, p.labelled, salt=3)
        .select(F.expr("cast(quality > 0 AS int)").alias("y"), id_mod(F.col("doc_id"), 4).alias("part"), x_of.alias("x"))
        .collect()
    )
    y = np.array([r["y"] for r in rows], float)
    held = np.array([r["part"] == 0 for r in rows], bool)
    if not rows or not (0 < y[held].sum() < held.sum() and 0 < y[~held].sum() < (~held).sum()):
        return None
    x = np.array([r["x"] for r in rows])
    views = make_views(x, p)

    # The views (bin edges, a few kB) travel with the closure, which is pickled by value.
    @F.pandas_udf("binary")
    def codes(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, langs, sources, sizes in batches:
            rows = [row_features(*r) for r in zip(texts, langs, sources, sizes)]
            if rows:
                yield pd.Series([c.tobytes() for c in all_codes(views, np.array(rows))], index=texts.index)
            else:
                yield pd.Series([], dtype=object)

    # Texts stay where they are; one row per id.
    ids = labels.select(F.col("doc_id").alias("l_id")).filter("l_id IS NOT NULL").distinct()
    slim = columns.select("doc_id", codes("text", "lang", "source", "n_chars").alias("codes"))
    free = (
        slim.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("codes").alias("codes"))
        .join(ids, F.col("doc_id") == F.col("l_id"), "left_anti")
        .select("codes", (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("u"))
    )
    path = shared_dir(docs.sparkSession, "quality_pool")
    free.write.parquet(path)
    pool = StoredPool(docs.sparkSession.read.schema("codes binary, u double").parquet(path))
    return co_train(x, y, pool, held, p, views)


def score_columns(model: Model | None, text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """struct<score, content_score, metadata_score>, each P(quality = 1)."""

    @F.pandas_udf("score double, content_score double, metadata_score double")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, sizes in batches:
            x = np.array([row_features(*r) for r in zip(texts, langs, sources, sizes)])
            x = x.reshape(-1, N_CONTENT + N_META + 2)
            s = model.scores(x) if model is not None else [np.full(len(x), 0.5)] * 3
            yield pd.DataFrame({"score": s[0], "content_score": s[1], "metadata_score": s[2]})

    return run(text, lang, source, n_chars)
