from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from texts (doc_ids from 0) or (doc_id, text, source) rows."""
    def make(rows):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (number, row, f"src{number % 3}")
            full.append((doc_id, text, "en", source, len(text) if text is not None else None))
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def invented():
    """Reproducible texts of invented words."""
    def write(seed, words, vocabulary=5000):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary)}x" for _ in range(words))

    return write


def rows_of(frame, *names):
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=str)
