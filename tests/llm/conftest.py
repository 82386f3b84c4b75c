import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ba", "de", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "é", "ü"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", ".\n"]) for w in words).strip()


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, repeated rows and one very long text."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    return [None, "", " ", "\n\t", "one", "one two", "Two words\nTwo words\n", "x" * 5000, long, long + " end", "a  b   c", "ÀÉ # $ %%", *[prose(rng, n) for n in (3, 60, 60, 200, 500)]]


@pytest.fixture(scope="session")
def documents(spark, odd_texts):
    """Odd texts, a hot source, copies, a repeated row, rows without a key and columns named like results."""
    rng = random.Random(5)
    rows = [(i, t, "en", "hot", len(t or "")) for i, t in enumerate(odd_texts)]
    rows += [(100 + i, prose(rng, rng.randint(1, 300)), rng.choice(["en", "fr", None]), rng.choice(["hot", "b", "c", None]), 1) for i in range(150)]
    rows += [(300 + i, rows[30][1], "en", "hot", 1) for i in range(40)]
    rows += [rows[20], rows[20], (None, "no key here", "en", "b", 1), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "'x' AS kept", "'x' AS fingerprint", "'x' AS component_id", "'x' AS taken", "'x' AS score", "'x' AS ids", "'x' AS shard", "'x' AS n_words")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.filter("false")
