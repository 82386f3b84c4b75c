import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def strings():
    """Reproducible random texts made of the characters that matter."""
    import random

    rng = random.Random(7)
    pieces = [
        "a", "b", "Z", "9", "x.org", "www.", "http://", "https://a", ".com", ".co", ".uk/", "-", "_", "@", "@@", ".", " ", "  ",
        "\t", "\r\n", "\u0085", " ", "﻿", " ", " ", "\x1c", "é", "ü", "お", "あ", "ﬁ",
        "Å", "é", "İ", "ß", "!", "?", "/", "I am", "dog", "clown", "here", "log in", "LOCKED", "blocked",
        "①", "½", "一", "\U0001f600", "Σ", "word", "Capital", "12", "̧", "ſ", "net",
    ]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 24))) for _ in range(4000)]
