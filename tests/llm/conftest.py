import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n, letters="abcdefgh"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    r = random.Random(4)
    long = words(r, 30_000)
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35), (2, None, "en", "a", None), (3, "", None, "b", 0),
        (4, " \t\n", "en", None, 3), (5, long, "en", "b", len(long)), (6, "ÄÖ é 中文 𝄞 x", "de", "c", 12),
        (7, "alpha beta gamma delta epsilon zeta", "en", "b", 35), (7, "alpha beta gamma delta epsilon zeta", "en", "b", 35),
        (None, "no id at all here", "en", "a", 17), (9, "one", None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def many_docs(spark):
    """Some hundred documents with copies and near copies; text by id."""
    r = random.Random(5)
    texts = {}
    for i in range(300):
        if i % 7 == 3 and i > 10:
            other = texts[r.choice(list(texts))].split(" ")
            if len(other) > 4 and i % 2:
                other[r.randrange(len(other))] = "changed"
            texts[i] = " ".join(other)
        else:
            texts[i] = words(r, r.choice([0, 1, 3, 5, 40, 120, 200]))
    rows = [(i, t, "en", f"s{i % 5}" if i % 11 else None, len(t)) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA), texts
