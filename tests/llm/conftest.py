import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, size int, n int, rate double, seed int, place long, band int, quality int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]), with extra columns that clash with internal names."""

    def build(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, "en", "web")[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, len(text or ""), 7, "x", 1, 2, 0.5, 3, 4, 5, 0))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty, blank and very long texts, repeated rows and repeated ids."""
    rng = random.Random(5)
    long_text = " ".join(f"w{rng.randrange(3000)}" for _ in range(30_000))
    return make([
        (1, "one two three four five six"), (1, "one two three four five six"), (1, "another text with the very same id"),
        (2, None), (3, ""), (4, " \n\t "), (5, long_text), (6, long_text), (None, "no id but words in it here"),
        (None, None), (7, "x" * 50_000), (8, "漢字 🙂 ▁   \x00", None, None), (-9, "one two three four five six", "de", None),
        (10, "..."), (11, "one"),
    ])


@pytest.fixture(scope="session")
def words_of():
    """Random sentences over a small vocabulary."""

    def draw(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
        return [f"t{rng.randrange(vocabulary)}" for _ in range(n)]

    return draw
