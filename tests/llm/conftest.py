import random

import pytest

WORDS = [a + b for a in ("ka", "mor", "li", "sen", "tu", "ran", "be", "du") for b in ("na", "vik", "sal", "do", "men", "ri", "ta", "go")]

#: Columns whose names the operators use for results of their own.
CLASHING = "kept boolean, fingerprint string, component_id bigint, n_words bigint, ids string, score double, label string, _row bigint, _fp bigint, held_out string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties."""
    clash = (True, "x", -5, 7, "x", 0.5, "x", 3, 9, "x")
    long_text = prose(1, 250_000)  # over a megabyte
    rows = [
        (0, prose(2, 120), "a", "s1", 700), (1, prose(2, 120), "a", "s2", 700), (2, None, None, None, None),
        (3, "", "a", "s1", 0), (4, " \t\n\v\f\r ", "a", "s1", 7), (5, long_text, "b", "s1", len(long_text)),
        (None, prose(3, 80), "b", "s1", 500), (None, None, None, None, None), (6, prose(4, 90), None, "s3", None),
        (6, prose(4, 90), None, "s3", None), (7, "é ß Σ 你好 \U0001F600", "b", None, 12), (8, "x", "a", "s1", 1),
    ]
    return [(*row, *clash) for row in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, columns=None):
    """Rows as a sorted list of tuples, nulls first."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
