import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigauge.llm import language

SYLLABLES = {"en": ["th", "er", "on", "an", "re", "he", "in", "ed"], "de": ["sch", "ei", "en", "ü", "ge", "lich"], "fr": ["eau", "é", "ou", "que", "ai"]}


def prose(rng, name, n):
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 4))).capitalize() for _ in range(n)) + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, name, rng.randint(3, 40)), name) for i in range(240) for name in [rng.choice(["en", "en", "en", "de", "fr"])]]
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 # $", "fr"), (303, rows[5][1], None), (None, rows[6][1], "en"), (304, prose(rng, "de", 20_000), "de")]
    rows += [rows[7], rows[7], (305, "x", "en"), (306, "日本 \U00020000\U0001f600", None), (307, "́ ́", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def taught():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(0)) != 2


class Brute:
    """Interpolated Kneser-Ney over dictionaries, by its definition."""

    def __init__(self, texts):
        self.counts = {k: Counter() for k in range(1, 5)}
        for word in (w for t in texts for w in words_of(t)):
            for i in range(3, len(word)):
                self.counts[4][word[i - 3 : i + 1]] += 1
        for k in (3, 2, 1):
            for gram, n in self.counts[k + 1].items():
                self.counts[k][gram[1:]] += n if k > 1 and gram[1] == "^" else 1
        self.cuts, self.totals, self.kinds = {}, {}, {}
        for k, table in self.counts.items():
            n1, n2 = (sum(n == x for n in table.values()) for x in (1, 2))
            self.cuts[k] = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
            self.totals[k], self.kinds[k] = Counter(), Counter()
            for gram, n in table.items():
                self.totals[k][gram[:-1]] += n
                self.kinds[k][gram[:-1]] += 1

    def share(self, gram, n_characters):
        k = len(gram)
        if k == 0:
            return 1 / (n_characters + 1)
        total = self.totals[k][gram[:-1]]
        if not total:
            return self.share(gram[1:], n_characters)
        own = max(self.counts[k][gram] - self.cuts[k], 0) / total
        return own + self.cuts[k] * self.kinds[k][gram[:-1]] / total * self.share(gram[1:], n_characters)

    def cost(self, text, n_characters):
        parts = [-math.log(self.share(w[i - 3 : i + 1], n_characters)) for w in words_of(text) for i in range(3, len(w))]
        return sum(parts) / len(parts)


def words_of(text):
    """Words with three marks before and one behind; letters and marks in lower case."""
    return ["^^^" + w + "$" for w in re.findall(r"(?:[^\W\d_]|[̀-ͯ])+", (text or "").lower())]


def test_costs_equal_the_definition(labelled):
    rows = [r for r in labelled.filter(taught()).collect() if r["lang"]]
    models = {name: Brute([r["text"] for r in rows if r["lang"] == name]) for name in SYLLABLES}
    n_characters = len({g for m in models.values() for g in m.counts[1]})
    found = language.fit(labelled, train=taught())
    assert found.languages == sorted(SYLLABLES)
    summed = language._summed(labelled, found, "text", ["doc_id", "text"]).filter("text IS NOT NULL AND _lid_sums IS NOT NULL")
    seen = 0
    for r in summed.collect():
        if len(r["text"]) < 400 and "́" not in r["text"] and "日" not in r["text"]:
            want = [models[name].cost(r["text"], n_characters) for name in found.languages]
            assert np.allclose(np.array(r["_lid_sums"]) / r["_lid_n"], want, rtol=2e-5)
            seen += 1
    assert seen > 200


def told(frame):
    return {(r["doc_id"], r["text"]): (r["lang_pred"], round(r["score"], 9), r["accepted"]) for r in frame.collect()}


def test_held_out_accuracy_and_defined_cases(labelled):
    got = language.identify(labelled.selectExpr("*", "1 AS score", "2 AS _n", "3 AS hash", "4 AS n"), train=taught())
    assert got.columns == ["doc_id", "text", "lang", "_n", "hash", "n", "lang_pred", "score", "accepted"] and got.count() == labelled.count()
    rows = got.filter(~taught() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}{5}")).collect()
    assert len(rows) > 40 and all(r["lang_pred"] == r["lang"] for r in rows)
    by_id = {r["doc_id"]: r for r in got.collect()}
    for key in (300, 301, 302, 307):
        assert (by_id[key]["lang_pred"], by_id[key]["score"], by_id[key]["accepted"]) == ("und", 0, False)
    assert by_id[306]["lang_pred"] in SYLLABLES and not by_id[306]["accepted"]  # letters no model has seen
    assert all(0 <= r["score"] <= 1 for r in by_id.values()) and by_id[304]["lang_pred"] == "de"
    assert sum(not r["accepted"] for r in got.filter(taught() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).collect()) <= 6


def test_blocks_and_partitions_change_nothing(labelled):
    whole = told(language.identify(labelled, train=taught()))
    model = language.fit(labelled, train=taught(), block_bytes=5000)
    assert len(model.blocks) > 2 and (np.sum(model.blocks, axis=0) == 1).all()
    assert told(language.identify(labelled.repartition(5), train=taught(), block_bytes=5000)) == whole


def test_counts_do_not_depend_on_neighbours(labelled):
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.lit("a").alias("lang"))
    counts = [sorted(map(tuple, language.count_strings(rows.repartition(n), "text", "lang").collect())) for n in (1, 7)]
    assert counts[0] == counts[1]


def test_without_training_rows(labelled):
    for frame in (labelled.withColumn("lang", F.lit(None).cast("string")), labelled.filter("false")):
        got = language.identify(frame).collect()
        assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got) and len(got) == frame.count()


def test_one_language(labelled):
    got = language.identify(labelled, train=F.col("lang") == "en").filter(F.col("text").rlike(r"\p{L}"))
    assert {r["lang_pred"] for r in got.collect()} == {"en"}


def test_characters():
    codes, ends, letters = language.characters([b"", "Éa 1 b́".encode(), b"12", "́".encode(), "\U00020000".encode()])
    assert codes[:5].tolist() == [ord("é"), ord("a"), 0, ord("b"), 0x301] and ends.tolist() == [0, 6, 6, 8, 10]
    assert letters.tolist() == [False, True, False, False, True]
    # "ab" ends as "cab" does in its last two characters, but not before the word.
    first, second = (language.strings_of(language.characters([t])[0]) for t in (b"ab", b"x ab"))
    assert first.tolist() == second.tolist()[2:]
