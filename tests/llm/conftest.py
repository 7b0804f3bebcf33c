import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package sent to its workers."""
    from labormart.llm.queries import ship_package

    ship_package(spark)
    return spark


SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, key string, tag string, removed string, copies int, item string"


@pytest.fixture(scope="session")
def odd(llm):
    """Nulls, empty, blank and long texts, ties, a repeated row, and columns whose names clash."""
    base = " ".join(f"word{i % 97} tail{i}" for i in range(120))
    near = base.replace("tail50", "changed")
    other = " ".join(f"other{i}" for i in range(80))
    long = " ".join(f"L{i % 5000}x{i % 7}" for i in range(60_000))
    texts = [
        (1, base, "a"), (2, base, "b"), (3, near, None), (4, None, "a"), (5, "", "a"), (6, " \t\n\x0b ", "b"), (7, "Hello", "a"), (8, "hello", "b"),
        (9, other + "\n" + base, "a"), (10, long, "a"), (11, other, None), (11, other, None), (12, "a b c d", "c"), (13, "ünï çødé " * 30, "c"), (None, None, None),
    ]
    return llm.createDataFrame([(d, t, s, "en", len(t or ""), "k", "t", "r", 7, "i") for d, t, s in texts], SCHEMA)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)
