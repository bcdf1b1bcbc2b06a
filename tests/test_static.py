"""Source-level guards: the library never uses the patterns the design rules out."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "ledgerline"

EVERYWHERE = {
    "localCheckpoint": r"localCheckpoint",
    "cross join": r"crossJoin|how=\"cross\"",
}
# The retail library only: the corpus operators may run Python inside tasks.
RETAIL_ONLY = {
    "python udf": r"\budf\(|pandas_udf|applyInPandas|mapInPandas|\.rdd\.map",
    "driver pull": r"toPandas\(",
}



def _sources(retail_only=False):
    for f in LIB.rglob("*.py"):
        name = f.relative_to(LIB).as_posix()
        if not (retail_only and name.startswith("llm/")):
            yield name, f.read_text()


def _hits(sources, patterns):
    return [
        (name, label)
        for name, text in sources
        for label, pattern in patterns.items()
        if re.search(pattern, text)
    ]


def test_no_forbidden_patterns():
    hits = _hits(_sources(), EVERYWHERE) + _hits(_sources(retail_only=True), RETAIL_ONLY)
    assert not hits, hits


def test_retail_library_never_collects():
    users = {name for name, text in _sources(retail_only=True) if ".collect()" in text}
    assert not users, users
