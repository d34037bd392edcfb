from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeinorstu", k=rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from a list of (doc_id, text), or of (doc_id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0 if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty and very long texts, repeated rows, one doc_id for two texts."""
    long = prose(1, 60_000)
    return docs_of([
        (1, None), (2, ""), (3, " \t\n "), (4, long), (5, prose(2, 40)), (5, prose(2, 40)), (6, "x" * 300_000),
        (7, prose(3, 30)), (7, prose(4, 30)), (None, prose(2, 40)), (None, None), (8, "\n\n\n"), (9, "é ü 漢字 🎉"),
    ])


CLASHING = (
    "_row", "_pos", "row", "node", "bands", "value", "kept", "class_id", "size", "copy", "taken", "_d", "_t", "_doc",
    "_text", "file", "path", "spans", "places", "item", "edits", "features", "fold", "p_toxic",
)


@pytest.fixture(scope="session")
def with_clashes():
    """The frame with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return lambda df: df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
