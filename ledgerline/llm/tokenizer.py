"""Byte-level BPE through a public vocabulary file (the path is a parameter).

The vocabulary is read on the driver (about 1 MB) and travels to the tasks
with their closure, so executors need no copy of the file. Nothing is trained.
"""

from __future__ import annotations

import base64
import re

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The pre-token pattern of the public byte-level BPE vocabulary.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The characters Unicode calls white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A pre-token never spans two of these: a run without white space, with at most
# one space before it, or the white space between such runs.
CHUNK = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
CACHE_ENTRIES = 100_000


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("byte_bpe", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of whole texts, as arrays."""

    def __init__(self, vocabulary: bytes):
        self.encode = encoding(vocabulary).encode_to_numpy

    def ids(self, text: str | None):
        return self.encode(text or "", disallowed_special=())


class Chunks:
    """Splits a text into pre-tokens chunk by chunk; the first chunks met are kept in a bounded cache."""

    def __init__(self, vocabulary: bytes):
        import regex

        self.encoding = encoding(vocabulary)
        self.pretokens = regex.compile(PRETOKEN).findall
        self.split = re.compile(CHUNK).findall
        self._leaves: dict[str, tuple] = {}

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """(characters, tokens) of each pre-token of a text, in order."""
        chars: list[int] = []
        tokens: list[int] = []
        cache, encode = self._leaves, self.encoding.encode_ordinary
        for chunk in self.split(text):
            got = cache.get(chunk)
            if got is None:
                parts = self.pretokens(chunk)
                got = ([len(p) for p in parts], [len(encode(p)) for p in parts])
                if len(cache) < CACHE_ENTRIES:
                    cache[chunk] = got
            chars += got[0]
            tokens += got[1]
        return chars, tokens
