import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"Wort{i % 977}" for i in range(30_000))

#: (doc_id, text): nulls, blanks, long texts, ties, repeats.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "Hello World"), (5, "hello world"), (6, "HELLO WORLD"),
    (6, "HELLO WORLD"), (7, LONG), (8, LONG + " end"), (9, "é" * 300), (None, "no id"), (10, "no id"),
    (11, "a" * 1000), (12, "x   y z"), (13, "One two three four five six seven eight nine ten eleven"),
]


@pytest.fixture
def odd(spark):
    """The odd rows with columns whose names operators use inside."""
    rows = [(d, t, "l", None if i % 3 else "s", i, 1, "h", 2, 3, f"r{i // 4}", i, "v") for i, (d, t) in enumerate(ODD)]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n int, fp int, hits string, size int, digest int, "
        "row_id string, `x.y` int, doc string",
    )


@pytest.fixture
def nothing(odd):
    return odd.limit(0)
