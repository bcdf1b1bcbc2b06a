"""Edit-aware token counts over per-document segment trees.

A document's pre-tokens (the units byte-level BPE encodes on their own) are
grouped into leaves of ``LEAF`` pre-tokens. A heap-shaped segment tree keeps
the characters and tokens below each node, so the whole document's count is
the root's sum. An edit descends by character sums to the leaves it touches,
re-splits and re-encodes only the changed text plus boundary context, and adds
the differences on the way up; untouched pre-tokens are never encoded again.

Boundary context: a pre-token depends on the text from its start to a few
characters past its end, so encoding starts again at the last boundary at
least ``LOOKAHEAD`` characters before the edit, and stops at the first
boundary behind the edit that the old split had too; from there on both
splits are equal, because the pattern scans forward without memory.

Edits of one document are (start, length, replacement) over its *original*
text and must not overlap; they are applied from the last to the first.

Defined cases: a null text is empty (no pre-tokens, no tokens); null or no
edits change nothing; an edit past the end of the text is cut to it; of two
overlapping edits the later start is dropped (counted in ``n_skipped``);
repeated rows give one result each. All work is per row, so there is no
shuffle, and a very long text only costs its own length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tokenizer import VOCABULARY, Chunks, read_vocabulary

LEAF = 64
LOOKAHEAD = 4
RESULT = (
    "n_pretokens long, n_tokens long, n_edits long, n_skipped long, "
    "n_reencoded long, n_tokens_after long, n_chars_after long"
)


class EditedText:
    """A text under edits: its untouched head, and what lies behind it in pieces.

    Edits from the last to the first copy each character once, however many
    they are; one that reaches behind an earlier edit joins the pieces first.
    """

    def __init__(self, text: str):
        self.head, self.cut = text, len(text)  # ``head`` counts up to ``cut``
        self.behind: list[str] = []  # pieces from there on, the nearest last
        self.length = len(text)

    def __len__(self) -> int:
        return self.length

    def replace(self, start: int, length: int, new: str) -> None:
        end = start + length
        if end > self.cut:
            self.head = self.slice(0, self.length)
            self.cut, self.behind = self.length, []
        self.behind += [x for x in (self.head[end : self.cut], new) if x]
        self.cut = start
        self.length += len(new) - length

    def slice(self, begin: int, end: int) -> str:
        parts = [self.head[begin : min(end, self.cut)]]
        at = self.cut
        for piece in reversed(self.behind):
            if at >= end:
                break
            parts.append(piece[max(0, begin - at) : end - at])
            at += len(piece)
        return "".join(parts)


class SegmentTree:
    """Sums of characters and tokens over leaves of pre-tokens."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = [
            (chars[i : i + LEAF], tokens[i : i + LEAF]) for i in range(0, len(chars), LEAF)
        ] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        for i, (c, t) in enumerate(self.leaves):
            self.chars[self.width + i] = sum(c)
            self.tokens[self.width + i] = sum(t)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one, past the end) and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        if leaf >= len(self.leaves):  # past the end
            leaf = len(self.leaves) - 1
            start = self.chars[1] - self.chars[self.width + leaf]
        return leaf, start

    def set(self, leaf: int, chars: list[int], tokens: list[int]) -> None:
        self.leaves[leaf] = (chars, tokens)
        node = self.width + leaf
        dc, dt = sum(chars) - self.chars[node], sum(tokens) - self.tokens[node]
        while node:
            self.chars[node] += dc
            self.tokens[node] += dt
            node //= 2

    def edit(self, text: EditedText, start: int, length: int, new: str, split) -> int:
        """Replace ``length`` characters from ``start``; the number of pre-tokens encoded again."""
        end = start + length
        first, at = self.find(max(0, start - LOOKAHEAD))
        # Back to a boundary that did not see the edit: within this leaf, or its start.
        chars, tokens = self.leaves[first]
        keep = 0
        while keep < len(chars) and at + chars[keep] <= start - LOOKAHEAD:
            at += chars[keep]
            keep += 1
        head_chars, head_tokens = chars[:keep], tokens[:keep]
        text.replace(start, length, new)
        shift = len(new) - length
        # Old boundaries behind the edit, leaf by leaf, until the splits agree.
        leaf, pos, inside = first, at, keep
        redone_chars: list[int] = []
        redone_tokens: list[int] = []
        p, goal = at, end
        take = 64
        while True:
            # Re-split a stretch of the edited text; its last pre-tokens may be cut short.
            stretch = text.slice(p, max(goal + shift, p) + take)
            cut = p + len(stretch) < len(text)
            c, t = split(stretch)
            if cut:
                short, left = len(stretch), len(c)
                while left and short > len(stretch) - LOOKAHEAD:
                    left -= 1
                    short -= c[left]
                c, t = c[:left], t[:left]
            for n_chars, n_tokens in zip(c, t):
                # Walk the old boundaries up to this position.
                while pos < p - shift or pos < end:
                    while inside >= len(self.leaves[leaf][0]):
                        if leaf + 1 >= len(self.leaves):
                            break
                        leaf, inside = leaf + 1, 0
                    if inside >= len(self.leaves[leaf][0]):
                        break
                    pos += self.leaves[leaf][0][inside]
                    inside += 1
                if p - shift >= end and pos == p - shift:
                    break
                redone_chars.append(n_chars)
                redone_tokens.append(n_tokens)
                p += n_chars
            else:
                if cut:
                    goal, take = max(goal, p - shift), take * 2
                    continue
                # The end of the text: nothing of the old split is left.
                leaf, inside, pos = len(self.leaves) - 1, len(self.leaves[-1][0]), self.chars[1]
            break
        tail = self.leaves[leaf]
        tail_chars, tail_tokens = tail[0][inside:], tail[1][inside:]
        for i in range(first + 1, leaf + 1):
            self.set(i, [], [])
        if leaf == first:
            self.set(
                first,
                head_chars + redone_chars + tail_chars,
                head_tokens + redone_tokens + tail_tokens,
            )
        else:
            self.set(first, head_chars + redone_chars, head_tokens + redone_tokens)
            self.set(leaf, tail_chars, tail_tokens)
        return len(redone_chars)


def edited_counts(text: str | None, edits, split) -> tuple:
    """One document's row of ``RESULT``."""
    text = text or ""
    chars, tokens = split(text)
    tree = SegmentTree(chars, tokens)
    before = tree.tokens[1]
    todo, end, skipped = [], -1, 0
    for start, length, new in sorted(edits if edits is not None else [], key=lambda e: e[0]):
        start = min(max(0, start), len(text))
        length = min(max(0, length), len(text) - start)
        if start < end:
            skipped += 1
            continue
        end = start + length
        todo.append((start, length, new or ""))
    redone, edited = 0, EditedText(text)
    for start, length, new in reversed(todo):
        redone += tree.edit(edited, start, length, new, split)
    return (len(chars), before, len(todo), skipped, redone, tree.tokens[1], tree.chars[1])


def count_tokens(
    docs: DataFrame, text: str = "text", edits: Column | None = None, vocabulary: str = VOCABULARY
) -> Column:
    """A struct column of ``RESULT`` for each row of ``docs``.

    ``edits``: array<struct<start int, length int, replacement string>> in
    characters of the text, or None for plain counts.
    """
    vocab = read_vocabulary(vocabulary)

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        split = Chunks(vocab).leaves
        names = [f.split()[0] for f in RESULT.split(", ")]
        for texts, lists in batches:
            rows = [
                edited_counts(t, [] if e is None else [(x["start"], x["length"], x["replacement"]) for x in e], split)
                for t, e in zip(texts, lists)
            ]
            yield pd.DataFrame(rows, columns=names)

    none = F.lit(None).cast("array<struct<start:int,length:int,replacement:string>>")
    return run(docs[text], none if edits is None else edits)


# Personal data that a cleaning pass replaces: e-mail addresses, and runs of
# digits with separators as phone, card and address numbers have them.
PERSONAL = r"[\w.+-]+@[\w-]+\.[\w.-]+|\+?\(?\d[\d().\- ]{5,}\d"


def redactions(text: Column, pattern: str = PERSONAL, replacement: str = "[removed]") -> Column:
    """Edits that replace each match of ``pattern``."""

    @F.pandas_udf("array<struct<start:int,length:int,replacement:string>>")
    def find(texts: pd.Series) -> pd.Series:
        spans = re.compile(pattern).finditer
        return texts.map(
            lambda t: [
                {"start": m.start(), "length": m.end() - m.start(), "replacement": replacement}
                for m in spans(t or "")
            ]
        )

    return find(text)
