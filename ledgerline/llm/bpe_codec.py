"""Byte-pair encoding by backtracking, and decoding through an offset table.

A text is cut into words by the vocabulary's own normaliser and pre-tokeniser;
what is written here is how a word becomes tokens. Plain byte-pair encoding
merges the pair of lowest rank again and again. The backtracking encoder gives
the same tokens from left to right in linear time:

- an Aho-Corasick automaton over the tokens gives the longest token that begins
  at a place; a table gives the next shorter one that begins as it does;
- two neighbours are compatible if merging their joined symbols leaves exactly
  these two. Undoing the merges of both, the later one first, shows every pair
  that ever met at their border; the neighbours are incompatible if one of
  these pairs would have merged before its own parts did. Results are kept in
  a table;
- a row of compatible neighbours is the encoding of what it covers, so the
  encoder takes the longest compatible token at each place. Where none fits it
  takes back the last token and marks the place as dead; no place dies twice.

Decoding joins the token strings with blanks, as the vocabulary file (which
names no decoder) asks for: all strings lie in one byte string, and tables of
offsets and lengths gather those of a whole batch at once.

How the work is spread: both directions are one map over rows, without any
shuffle. The vocabulary is read on the driver (its path is a parameter) and
travels to the tasks with their closure. Runs without white space are encoded
once per task while a bounded table of them has room.

Defined cases: a null or empty text has no tokens, and decodes to the empty
text; the strings of special tokens in a text are their ids, as in the
library; repeated rows give repeated results; a very long word costs its
length; an id outside the vocabulary decodes to nothing, as in the library;
null ids decode to the empty text. Columns beside the text are never touched.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.llm.tokenizer import SPACE

KEPT_CHARS = 64  # longest run without white space that is kept
KEPT_CHUNKS, KEPT_WORDS = 250_000, 150_000  # entries of a generation
PAIRS = 500_000
BLOCK = 200_000  # ids decoded at a time
# The pre-token pattern of the public vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII and the Latin letters up to U+017F: the normaliser changes
# nothing but their case there (U+0130 apart), and the pattern reads as follows.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch
LATIN = "a-z\u00df-\u00f6\u00f8-\u017f"
PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^{LATIN}0-9]+").findall
LAST = 0x10000  # added to a word's last symbol, where the vocabulary marks word ends


def byte_chars() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes that are not printable."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(odd)}


BYTE_CHARS = byte_chars()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str | None = None) -> bytes:
    with open(path or default_vocabulary(), "rb") as f:
        return f.read()


class Merges:
    """The merge rules as numbers: symbols first, then one number a merge, by rank."""

    def __init__(self, model: dict):
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab, rules = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {a + b for a, b in rules}
        if len(made) != len(rules):
            raise ValueError("a token has two merges: its rank is not defined")
        symbols = sorted((t for t in vocab if t not in made), key=vocab.get)
        numbers = {t: i for i, t in enumerate(symbols)}
        self.base = len(symbols)
        self.ids = [vocab[t] for t in symbols]
        self.texts = [self.spelled(t) for t in symbols]
        self.left, self.right = list(range(self.base)), list(range(self.base))
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in rules:
            pair, number = (numbers[a], numbers[b]), len(self.ids)
            self.merged[pair] = numbers[a + b] = number
            self.left.append(pair[0])
            self.right.append(pair[1])
            self.ids.append(vocab[a + b])
            self.texts.append(self.texts[pair[0]] + self.texts[pair[1]])

    def spelled(self, symbol: str) -> str:
        """A symbol as one character, one that ends a word as another."""
        if self.suffix and symbol != self.suffix and symbol.endswith(self.suffix):
            symbol = chr(ord(symbol[: -len(self.suffix)]) + LAST)
        if len(symbol) != 1:
            raise ValueError(f"not a single symbol: {symbol!r}")
        return symbol

    def word(self, text: str) -> str:
        return text[:-1] + chr(ord(text[-1]) + LAST) if self.suffix else text

    def compatible(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether no pair merges across the border of a and b before ``before``."""
        a_end = b_end = before
        while True:
            m = self.merged.get((a, b))
            # Of equal ranks the left pair merges first.
            if m is not None and m < a_end and m <= b_end:
                return False
            if a < self.base and b < self.base:
                return True
            if a > b:
                a_end, a = a, self.right[a]
            else:
                b_end, b = b, self.left[b]


class WordEncoder:
    """Ids of single words."""

    def __init__(self, merges: Merges):
        import ahocorasick

        self.merges = merges
        self.pairs: dict[tuple[int, int], bool] = {}
        self.sizes = [len(x) for x in merges.texts]
        self.whole: dict[str, int] = {}
        usable = [True] * len(merges.ids)
        automaton = ahocorasick.Automaton()
        for t, text in enumerate(merges.texts):
            if t >= merges.base:
                a, b = merges.left[t], merges.right[t]
                usable[t] = usable[a] and usable[b] and merges.compatible(a, b, t)
            if usable[t]:
                automaton.add_word(text, t)
                self.whole[text] = t
        automaton.make_automaton()
        self.longest = automaton.iter_long
        # The longest token that a token begins with, itself apart, or -1.
        self.shorter = [-1] * len(merges.ids)
        for text, t in self.whole.items():
            for n in range(len(text) - 1, 0, -1):
                if (shorter := self.whole.get(text[:n])) is not None:
                    self.shorter[t] = shorter
                    break

    def fits(self, a: int, b: int) -> bool:
        known = self.merges.compatible(a, b)
        if len(self.pairs) < PAIRS:
            self.pairs[a, b] = known
        return known

    def tokens(self, word: str) -> list[int]:
        """Numbers of the tokens of a word (see ``Merges.word``)."""
        whole = self.whole.get(word)
        if whole is not None:
            return [whole]
        sizes, shorter, pairs, longest = self.sizes, self.shorter, self.pairs, self.longest
        begins = {end + 1 - sizes[t]: t for end, t in longest(word)}  # the longest token at a place
        taken: list[int] = []
        dead: set[int] = set()
        at, n, last, t = 0, len(word), -1, begins.get(0, -1)
        while True:
            while t >= 0:
                if last < 0:
                    fits = True
                elif (fits := pairs.get((last, t))) is None:
                    fits = self.fits(last, t)
                if fits and at + sizes[t] not in dead:
                    break
                t = shorter[t]
            if t < 0:
                if not taken:
                    raise ValueError("a symbol of the word is not in the vocabulary")
                dead.add(at)
                t = taken.pop()
                at -= sizes[t]
                last, t = taken[-1] if taken else -1, shorter[t]
                continue
            taken.append(t)
            at += sizes[t]
            if at == n:
                return taken
            last, t = t, begins.get(at, -1)
            if t < 0:
                begins[at] = t = next(longest(word, at))[1]


def lower_words(about: dict) -> bool:
    """Whether a vocabulary lower-cases its texts and cuts them by ``WORD_PATTERN``."""
    steps = [s["type"] for s in about["normalizer"].get("normalizers", [])]
    cuts = about["pre_tokenizer"].get("pretokenizers", [])
    split = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0] == split
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
    )


class Kept:
    """A bounded table of two generations: what is asked for again outlives a change of generation."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, key: str) -> bytes:
        """The value of a key that is not in ``new``."""
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > KEPT_CHARS:
                return value
        self.new[key] = value
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        return value


class TextEncoder:
    """Ids of whole texts, as the bytes of 32-bit integers."""

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        about = json.loads(vocabulary)
        library = Tokenizer.from_str(vocabulary.decode())  # for its normaliser and pre-tokeniser only
        self.normalise, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.plain = PLAIN if lower_words(about) else lambda part: None
        self.special = {t["content"]: t["id"] for t in about["added_tokens"]}
        by_length = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        merges = Merges(about["model"])
        words, numbers = WordEncoder(merges), merges.ids
        self.merges, self.encoder = merges, words
        self.words = Kept(
            lambda w: array("i", [numbers[t] for t in words.tokens(merges.word(w))]).tobytes(), KEPT_WORDS
        )
        self.chunks = Kept(self.encoded, KEPT_CHUNKS)
        self.split = re.compile(f"[^{SPACE}]+").findall

    def encoded(self, chunk: str) -> bytes:
        """Ids of a run without white space: no word and no special token reaches beyond one."""
        ids, words = bytearray(), self.words
        for part in self.specials.split(chunk) if self.specials and "<" in chunk else (chunk,):
            if part in self.special:
                ids += array("i", [self.special[part]]).tobytes()
            elif part:
                if self.plain(part):
                    texts = PLAIN_WORDS(part.lower())
                    if not part.isascii():
                        texts = [t.encode().decode("latin-1").translate(BYTE_CHARS) for t in texts]
                else:
                    texts = [t for t, _ in self.cut(self.normalise(part))]
                for text in texts:
                    ids += words.new.get(text) or words.missing(text)
        return bytes(ids)

    def add(self, text: str | None, out: bytearray) -> None:
        """Puts the ids of a text behind ``out``."""
        chunks = self.chunks
        new, missing = chunks.new, chunks.missing
        for chunk in self.split(text) if text else ():
            ids = new.get(chunk)
            if ids is None:
                ids = missing(chunk)
                new = chunks.new
            out += ids

    def ids(self, text: str | None) -> list[int]:
        out = bytearray()
        self.add(text, out)
        return np.frombuffer(out, np.int32).tolist()


class Decoder:
    """Texts of id lists: one byte string of all tokens, with their offsets and lengths."""

    def __init__(self, vocabulary: bytes):
        about = json.loads(vocabulary)
        by_id = {i: t for t, i in about["model"]["vocab"].items()} | {
            t["id"]: t["content"] for t in about["added_tokens"]
        }
        strings = [(by_id[i] + " ").encode() if i in by_id else b"" for i in range(max(by_id, default=-1) + 1)]
        strings.append(b"")  # of ids that the vocabulary does not have
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.strings = np.frombuffer(b"".join(strings), np.uint8)

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all lists, one after the other, and where each ends; ``ends``: the lists' ends in ids."""
        none = len(self.sizes) - 1
        at = np.where((ids >= 0) & (ids < none), ids, none)
        sizes = self.sizes[at]
        before = np.concatenate([[0], np.cumsum(sizes)])
        # No blank behind a list's last string.
        spoken = np.flatnonzero(sizes)
        last = np.searchsorted(spoken, ends) - 1
        begins = np.concatenate([[0], ends[:-1]])
        full = (last >= 0) & (before[ends] > before[begins])
        sizes[spoken[last[full]]] -= 1
        total = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(total[-1], np.uint8)
        for lo in range(0, len(ids), BLOCK):
            hi = min(lo + BLOCK, len(ids))
            shift = self.offsets[at[lo:hi]] - total[lo:hi]
            out[total[lo] : total[hi]] = self.strings[
                np.repeat(shift, sizes[lo:hi]) + np.arange(total[lo], total[hi])
            ]
        return out, total[ends]


def encode(text: Column, vocabulary: bytes | None = None) -> Column:
    """array<int>: the token ids of a text."""
    known = vocabulary if vocabulary is not None else read_vocabulary()

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = TextEncoder(known)
        for batch in batches:
            values, ends = bytearray(), [0]
            for t in batch:
                encoder.add(t.as_py(), values)
                ends.append(len(values) // 4)
            flat = np.frombuffer(values, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return ids(text)


def decode(ids: Column, vocabulary: bytes | None = None) -> Column:
    """The text that a list of token ids stands for."""
    known = vocabulary if vocabulary is not None else read_vocabulary()

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(known)
        for batch in batches:
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = batch.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            parts, offsets, row = [], [np.zeros(1, np.int64)], 0
            while row < len(sizes):  # a block of lists at a time
                begin = ends[row] - sizes[row]
                to = max(row + 1, int(np.searchsorted(ends, begin + BLOCK, side="right")))
                out, at = decoder.texts(values[begin : ends[to - 1]], ends[row:to] - begin)
                parts.append(out.tobytes())
                offsets.append(at + offsets[-1][-1])
                row = to
            joined = np.concatenate(offsets).astype(np.int32)
            yield pa.StringArray.from_buffers(len(sizes), pa.py_buffer(joined), pa.py_buffer(b"".join(parts)))

    return text(ids)
