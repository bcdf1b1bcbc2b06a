"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to symbols (insult, harm, intent, target, negation, reporting
verb, quotation mark, clause end, other). Small transducers read the symbols:
one accepts threats as sequences (an intent, a few words, a target perhaps
among them, then a verb of harm; a verb of harm alone is the weaker form), one
insults (said of a target a few words before, or only mentioned), one follows
negation for a few words, one reported speech to the end of its clause or
quotation, one whether a clause has a target. They are composed into one
machine, whose states give every match its pattern: insult or threat, full or
weak form, negated or not, reported or not, aimed at a target or not. What is
scored is the clause: at its end its matches count with their weights under
their patterns; the sums per pattern, and all of them in relation to the
length, make a document's score by a logistic link.

The insult lexicon is learned from labelled documents: whole words, and stems
(prefixes) shared by several words, that stand in toxic documents far more
often than chance allows; an entry weighs its log-odds. Copies are collapsed
before counting, or the words of one much-copied text would look like
insults (texts whose smallest hash of three words is equal count once). The pattern weights are fitted on other labelled documents than
the lexicon, around prior weights (a negated or reported insult counts less),
which stay where the labels tell nothing.

Bounds: at most ``sample`` labelled documents are learned from, and at most
``entries`` words and as many stems are kept. Every text is scored whole, in
one pass without a shuffle.

Defined cases: a null or empty text has no matches and gets the score of a
document without any; without labels of both kinds a short built-in lexicon
and the prior weights are used; repeated rows get equal scores; words longer
than any entry match by their stem only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_mod
from ledgerline.llm.sampling import labelled
from ledgerline.session import shared_dir

OTHER, INSULT, HARM, TARGET, NEGATION, REPORT, QUOTE, CLAUSE, INTENT = range(9)
N_SYMBOLS = 9
NEGATION_REACH = 3
INTENT_REACH = 4
DIRECT_REACH = 4
REACH = max(NEGATION_REACH, INTENT_REACH, DIRECT_REACH)  # other words that any state remembers

# Small word classes in English, German, French and Spanish.
HARMS = "kill hurt destroy beat burn stab shoot umbringen schlagen vernichten tuer frapper matar golpear"
INTENTS = (
    "will shall going gonna want must should ll werde werden will wirst soll sollte vais va vas veux voy vas "
    "quiero debe"
)
TARGETS = (
    "you your yours he she they him her them his their du dich dir dein ihr euch sie er "
    "tu toi vous ton il elle ils usted ustedes ellos ellas"
)
NEGATIONS = "not no never nor without nicht kein keine nie ohne ne pas jamais sans ni nunca sin"
REPORTS = (
    "said says say wrote writes called claimed reported quoted sagte schrieb nannte "
    "disait dit rapporte dijo dice"
)
INSULTS = "idiot moron stupid scum worthless pathetic idiote stupide dumm idiota"
BUILT_IN_WEIGHT = 6.0

TOKENS = re.compile(r"[^\W_]+|[.!?;:|\n]|[\"“”„«»]")
SCALE = 5.0  # weights are divided by it before the link


@dataclass(frozen=True)
class ToxicityParams:
    sample: int = 16_000
    entries: int = 20_000
    shortest: int = 3  # stems have this many characters at least
    longest: int = 8
    stem_words: int = 3  # different words behind a stem
    doubt: float = 0.01  # expected number of chance entries
    lift: float = 3.0  # least log-odds of an entry
    ridge: float = 2.0


# ------------------------------------------------------------------ transducers


@dataclass(frozen=True)
class Transducer:
    """``step(state, symbol)`` -> next state; ``flag(state)`` -> 0 or 1."""

    states: int
    step: object
    flag: object


def _negation(state: int, symbol: int) -> int:
    if symbol == NEGATION:
        return NEGATION_REACH
    return 0 if symbol == CLAUSE else max(0, state - 1)


def _reported(state: int, symbol: int) -> int:
    """1: after a reporting verb, to the end of the clause; 2: within quotation marks."""
    if symbol == QUOTE:
        return 0 if state == 2 else 2
    if state == 2:
        return 2
    if symbol == REPORT:
        return 1
    return 0 if symbol == CLAUSE else state


def _target(state: int, symbol: int) -> int:
    return 1 if symbol == TARGET else 0 if symbol == CLAUSE else state


def _threat(state: int, symbol: int) -> int:
    """How many words an intent still reaches: a verb of harm there completes a threat."""
    if symbol == INTENT:
        return INTENT_REACH
    if symbol in (CLAUSE, HARM):
        return 0
    return state if symbol == TARGET else max(0, state - 1)


def _direct(state: int, symbol: int) -> int:
    """How many words a target still reaches: an insult there is said of it.

    Who says or writes something is no target of what is said.
    """
    if symbol == TARGET:
        return DIRECT_REACH
    if symbol in (CLAUSE, REPORT):
        return 0
    return state if symbol == INSULT else max(0, state - 1)


NEGATED = Transducer(NEGATION_REACH + 1, _negation, lambda s: int(s > 0))
REPORTED = Transducer(3, _reported, lambda s: int(s > 0))
AIMED = Transducer(2, _target, lambda s: s)
THREATENED = Transducer(INTENT_REACH + 1, _threat, lambda s: int(s > 0))
DIRECT = Transducer(DIRECT_REACH + 1, _direct, lambda s: int(s > 0))


def machine() -> tuple[list[list[int]], list[tuple[int, ...]]]:
    return compose(NEGATED, REPORTED, AIMED, THREATENED, DIRECT)


def compose(*parts: Transducer) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """One machine that runs the parts side by side: next states and the parts' flags by state."""
    tuples = [()]
    for p in parts:
        tuples = [t + (s,) for t in tuples for s in range(p.states)]
    number = {t: i for i, t in enumerate(tuples)}
    following = [
        [number[tuple(p.step(s, y) for p, s in zip(parts, t))] for y in range(N_SYMBOLS)] for t in tuples
    ]
    return following, [tuple(p.flag(s) for p, s in zip(parts, t)) for t in tuples]


# Patterns: (insult or threat) x full form x negated x reported x aimed.
N_PATTERNS = 32
LENGTH, DENSITY, ONE = N_PATTERNS, N_PATTERNS + 1, N_PATTERNS + 2
N_FEATURES = N_PATTERNS + 3


def pattern(kind: int, full: int, negated: int, reported: int, aimed: int) -> int:
    return (kind == HARM) * 16 + full * 8 + negated * 4 + reported * 2 + aimed


def prior_weights() -> np.ndarray:
    out = np.ones(N_FEATURES)
    for kind in (INSULT, HARM):
        for i in range(16):
            full, negated, reported, aimed = i >> 3 & 1, i >> 2 & 1, i >> 1 & 1, i & 1
            out[pattern(kind, full, negated, reported, aimed)] = (
                (0.5 if negated else 1.0)
                * (0.5 if reported else 1.0)
                * (1.25 if aimed else 1.0)
                * (0.75 if kind == HARM and not full else 1.0)
            )
    out[LENGTH] = -0.1
    out[DENSITY] = 0.0
    out[ONE] = -2.0
    return out


# ------------------------------------------------------------------ grammar


@dataclass
class Grammar:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=prior_weights)
    longest: int = 8
    shortest: int = 3


class Symbols(dict):
    """word -> (symbol, weight), or None for other words; filled as words are met, within a bound."""

    def __init__(self, grammar: Grammar, most: int = 400_000):
        super().__init__()
        self.grammar, self.most = grammar, most
        for words, symbol in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
            self.update((w, (symbol, 0.0)) for w in words.split())
        self.update((w, (INTENT, 0.0)) for w in INTENTS.split())
        self.update((w, (HARM, BUILT_IN_WEIGHT)) for w in HARMS.split())
        self.update((c, (CLAUSE, 0.0)) for c in ".!?;:|\n")
        self.update((c, (QUOTE, 0.0)) for c in '"“”„«»')
        self.update((w, (INSULT, x)) for w, x in grammar.words.items())

    def __missing__(self, word: str):
        g = self.grammar
        weight = max(
            (g.stems.get(word[:k], 0.0) for k in range(g.shortest, min(g.longest, len(word)) + 1)), default=0.0
        )
        found = (INSULT, weight) if weight else None
        if len(self) < self.most:
            self[word] = found
        return found


def features(text: str | None, symbols: Symbols, machine) -> np.ndarray:
    """Sums of clause weights by pattern, the log of the length, all weights a hundred words, and 1."""
    out = np.zeros(N_FEATURES)
    out[ONE] = 1.0
    tokens = TOKENS.findall((text or "").lower())
    out[LENGTH] = math.log1p(len(tokens))
    found = [(i, s) for i, s in enumerate(map(symbols.__getitem__, tokens)) if s is not None]
    if not any(s[0] in (INSULT, HARM) for _, s in found):
        return out
    following, flags = machine
    state, at, pending = 0, -1, []
    found.append((len(tokens), (CLAUSE, 0.0)))
    for i, (symbol, weight) in found:
        for _ in range(min(i - at - 1, REACH)):
            state = following[state][OTHER]
        at = i
        negated, reported, aimed, threatened, direct = flags[state]
        if symbol in (INSULT, HARM):
            pending.append((symbol, threatened if symbol == HARM else direct, negated, reported, weight))
        elif symbol == CLAUSE:
            for kind, full, no, told, w in pending:
                out[pattern(kind, full, no, told, aimed)] += w / SCALE
            pending = []
        state = following[state][symbol]
    out[DENSITY] = 100 * out[:N_PATTERNS].sum() / (len(tokens) + 50)
    return out


def link(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -60, 60)))


# ------------------------------------------------------------------ learning


def _evidence(t: Column, c: Column, base: float) -> Column:
    """(t + c) * KL(t / (t + c) || base): minus the log of the chance of so many toxic ones."""
    n = t + c
    share = t / n
    clean = F.when(c > 0, c * F.log(c / n / (1 - base))).otherwise(0.0)
    return F.when(share > base, t * F.log(share / base) + clean).otherwise(0.0)


def learn_lexicon(sample: DataFrame, p: ToxicityParams, root: str) -> tuple[dict, dict]:
    """(words, stems) with weights, from rows (text, toxic)."""
    spark = sample.sparkSession

    def least_shingle(text: str | None) -> int:
        import xxhash

        words = TOKENS.findall((text or "").lower())
        shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        return min(xxhash.xxh3_64_intdigest(s) >> 1 for s in shingles)

    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([least_shingle(t) for t in texts], dtype="int64")

    mark = F.pandas_udf(sketch, "long")
    one = sample.select("toxic", "text", mark("text").alias("mark")).groupBy("mark", "toxic").agg(
        F.min("text").alias("text")
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        docs = [0, 0]
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                docs[toxic] += 1
                counts[toxic].update(w for w in set(TOKENS.findall((text.as_py() or "").lower())) if w.isalnum())
        words = ["", *(counts[0].keys() | counts[1].keys())]  # '' counts the documents
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                pa.array([docs[1], *(counts[1][w] for w in words[1:])], pa.int64()),
                pa.array([docs[0], *(counts[0][w] for w in words[1:])], pa.int64()),
            ],
            names=["word", "t", "c"],
        )

    parts = one.select("text", F.expr("cast(toxic > 0 AS int)")).mapInArrow(partial, "word string, t long, c long")
    parts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).write.parquet(f"{root}/words")
    words = spark.read.schema("word string, t long, c long").parquet(f"{root}/words")
    total = words.filter("word = ''").agg(F.sum("t"), F.sum("c")).first()
    n_toxic, n_clean = (x or 0 for x in total)
    if not n_toxic or not n_clean:
        return {}, {}
    base = n_toxic / (n_toxic + n_clean)
    words = words.filter("word <> ''")
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    weight = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))

    def entries(table: DataFrame, name: str, halve: float) -> dict[str, float]:
        least = math.log(max(table.count(), 1) / p.doubt)
        rows = (
            table.filter(F.col("t") > 0)
            .select(name, weight.alias("w"), (_evidence(t, c, base) * halve).alias("e"))
            .filter((F.col("e") > least) & (F.col("w") > p.lift))
            .orderBy(F.desc("e"), name)
            .limit(p.entries)
            .collect()
        )
        return {r[name]: r["w"] for r in rows}

    whole = entries(words, "word", 1.0)
    # Stems from what is left: a word that is an entry itself must not speak for its neighbours.
    taken = spark.createDataFrame([(w,) for w in whole], "word string")
    left = words.join(taken, "word", "left_anti")
    lengths = F.sequence(F.lit(p.shortest), F.least(F.length("word"), F.lit(p.longest)))
    stems = (
        left.filter(F.length("word") >= p.shortest)
        .select("t", "c", F.explode(F.transform(lengths, lambda k: F.substring("word", F.lit(1), k))).alias("stem"))
        .groupBy("stem")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(F.col("t") > 0).alias("n"))
        .filter(F.col("n") >= p.stem_words)
    )
    # A document may hold several words of a stem: count its evidence half.
    return whole, entries(stems, "stem", 0.5)


def fit_weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression around prior weights (Newton steps)."""
    beta = prior.copy()
    for _ in range(40):
        p = link(x, beta)
        grad = x.T @ (p - y) + ridge * (beta - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> Grammar:
    """Learn from the labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    p, spark = params, docs.sparkSession
    root = shared_dir(spark, "toxicity")
    rows = labelled(
        docs.select("doc_id", "text"), labels, "toxic", id_mod(F.col("l_id"), 5) != 0, p.sample
    ).select("text", F.expr("cast(toxic > 0 AS int)").alias("toxic"), id_mod(F.col("doc_id"), 3).alias("part"))
    rows.write.parquet(f"{root}/sample")
    rows = spark.read.schema(rows.schema).parquet(f"{root}/sample")
    words, stems = learn_lexicon(rows.filter("part <> 0").select("text", "toxic"), p, root)
    grammar = Grammar(words, stems, longest=p.longest, shortest=p.shortest)
    if not words and not stems:
        grammar.words = {w: BUILT_IN_WEIGHT for w in INSULTS.split()}
    # At most ``sample`` rows of 35 numbers.
    fit = rows.filter("part = 0").select("toxic", feature_column(F.col("text"), grammar).alias("x")).collect()
    y = np.array([r["toxic"] for r in fit], float)
    if 0 < y.sum() < len(y):
        grammar.weights = fit_weights(np.array([r["x"] for r in fit]), y, prior_weights(), p.ridge)
    return grammar


def feature_column(text: Column, grammar: Grammar) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        symbols, composed = Symbols(grammar), machine()
        for texts in batches:
            yield pd.Series([features(t, symbols, composed) for t in texts])

    return run(text)


def score_column(text: Column, grammar: Grammar) -> Column:
    """The score (0 to 1) of each text, as a double."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        symbols, composed = Symbols(grammar), machine()
        for texts in batches:
            x = np.array([features(t, symbols, composed) for t in texts]).reshape(-1, N_FEATURES)
            yield pd.Series(link(x, grammar.weights))

    return run(text)
