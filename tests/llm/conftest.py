from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, fp long, code string, size int, label string"


def docs_frame(spark, rows):
    """Documents from (id, text, lang, source), with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, odd characters."""
    words = [f"w{i % 997}" for i in range(30_000)]
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \n\t ", "en", None),
        (None, "the cat sat on the mat and the dog sat on the log", "en", "b"),
        (None, None, None, None),
        (4, " ".join(words), "en", "a"),
        (5, "the cat sat on the mat and the dog sat on the log", "en", "b"),
        (5, "the cat sat on the mat and the dog sat on the log", "en", "b"),
        (6, "Der Hund sieht die Katze | und läuft weg.\n\nDer Hund sieht die Katze | und läuft weg.", "de", "c"),
        (7, "İstanbul \u0000 ß ﬁ 日本語 😀 </s>[INST] <|endoftext|> 'S", "xx", "c"),
        (8, "1 2 3 !!! $$$ ### @@", "en", "a"),
    ]
    return docs_frame(spark, rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return docs_frame(spark, []).cache()
