import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, shard int, size string, kept boolean"
CLASH = ("x", 7, "y", None)  # extra columns whose names the operators use themselves


def edge_rows():
    """NULLs in every column, empty, blank, tiny and long texts, ties and repeated rows."""
    rnd = random.Random(11)
    prose = [" ".join(rnd.choice(["the", "of", "and", "river", "stone", "light", "walks", "Under"]) for _ in range(60)) for _ in range(6)]
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "Re.", "en", "b"), (5, "42 !!", "de", None),
        (None, prose[0], "en", "a"), (None, prose[0], "en", "a"), (None, None, None, None),
        (6, prose[1], "en", "a"), (7, prose[1], "en", "b"), (8, prose[1] + " end", "en", "c"), (8, prose[2], None, "c"),
        (9, "word " * 30_000, "en", "a"), (10, "a" * 50_000, "en", "z"), (11, "line one here\n" * 5 + prose[3], "en", "ü"),
        (12, prose[4], "en", "a"), (12, prose[4], "en", "a"), (13, "é" * 300 + " 😀 " + prose[5], "fr", "a"), (-5, prose[2], "en", ""),
    ]
    return [(*r, None if r[1] is None else len(r[1]), *CLASH) for r in rows]


@pytest.fixture()
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
