from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs."""

    def build(rows, lang="en", source="src1"):
        full = [(i, t, lang, source, len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def prose():
    """Seeded prose: ``prose(seed, n)`` is a text of n words."""

    def text(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n))

    return text


#: Nulls, empty and wordless texts, ties, repeated rows, a very long text.
@pytest.fixture(scope="session")
def odd(prose):
    return [
        (None, None), (None, "text of nobody"), (1, None), (2, ""), (3, " \n\t"), (4, "!!!"), (5, "!!!"),
        (6, "one"), (6, "one"), (7, "Ünï çødé wörds hére"), (8, prose(8, 60_000)), (9, "a" * 300_000),
        (10, "tie tie tie"), (11, "tie tie tie"),
    ]
