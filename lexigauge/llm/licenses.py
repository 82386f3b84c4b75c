"""License notices found by diagonal voting.

Every pair of consecutive words of a text is joined by hash to the positions of the same pair in the templates (short notices, so
a table of fixed size that is broadcast). A match votes for a diagonal: its position in the text minus that in the template.
Votes are added up per document, template and diagonal. A diagonal with a vote for every pair of the template is a place where
its words stand consecutively. Diagonals of a template that lie close together, shifted by words put in or left out, merge into
one span, which is verified: it counts when enough different pairs of the template stand in it, in the template's order. Each vote
compares the words themselves, so hashes decide nothing. All this is sorting and windows of a few rows, so a text full of matches
takes time in proportion to them.

Defined cases: null and empty texts, and texts of one word, have no places; repeated rows are counted each for itself; an empty table gives an
empty result; further columns are returned if named in `keep`, unless they are named like a result.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: Words of the base phrases and their labels.
BASE: Mapping[str, str] = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices that the method looks for with gaps, and their labels.
NOTICES: Mapping[str, Sequence[str]] = {
    "apache-2.0": (
        "licensed under the apache license version 2 0", "you may not use this file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution",
    ),
    "cc-by-sa": ("creative commons attribution sharealike", "licensed under cc by sa 4 0"),
    "cc-by-nc": ("creative commons attribution noncommercial", "licensed under cc by nc 4 0"),
    "gpl-notice": (
        "licensed under the gnu general public license version 3", "you can redistribute it and or modify it under the terms of the gnu",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose",
    ),
    "lgpl": ("gnu lesser general public license",),
    "mit": (
        "released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    "mpl": ("subject to the terms of the mozilla public license",),
    "no-warranty": ("provided as is without warranty of any kind",),
}
#: Least share of a notice's pairs in a span, and the most words put in or left out between neighbouring diagonals.
COVER, SHIFT = 0.8, 2
#: A template's pairs are the bits of a number.
MOST_WORDS = 63
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def templates(spark: SparkSession, base: Mapping[str, str] = BASE, notices: Mapping[str, Sequence[str]] = NOTICES) -> DataFrame:
    """A row per pair of words of a template."""
    rows, named = [], [(True, label, phrase) for phrase, label in base.items()]
    named += [(False, label, phrase) for label, phrases in notices.items() for phrase in phrases]
    for number, (is_base, label, phrase) in enumerate(named):
        words = phrase.split()
        if not 2 <= len(words) <= MOST_WORDS:
            raise ValueError(f"a template has two to {MOST_WORDS} words")
        rows += [(number, is_base, label, len(words) - 1, at, a, b) for at, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    names = ("template", "is_base", "label", "pairs", "at", "w1", "w2")
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).withColumn("hash", F.xxhash64("w1", "w2"))


def votes(docs: DataFrame, text: str, table: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(KEEP, _lic_row, n_words, template, diagonal, votes, first, last, mask): a row per diagonal with a vote, and one per document
    without. `mask` has a bit for every pair of the template that voted. KEEP is `keep` under numbered names.
    """
    named = [F.col(c).alias(f"_lic_{i}") for i, c in enumerate(keep)]
    kept = [f"_lic_{i}" for i in range(len(keep))]
    words = docs.select(*named, words_of(text).alias("_words"), F.monotonically_increasing_id().alias("_lic_row"))
    words = words.withColumn("n_words", F.size("_words").cast("long"))
    n = F.size("_words")
    pairs = F.when(n > 1, F.arrays_zip(F.slice("_words", 1, F.greatest(n - 1, F.lit(1))).alias("w1"), F.slice("_words", 2, F.greatest(n - 1, F.lit(1))).alias("w2")))
    exploded = words.select(*kept, "_lic_row", "n_words", F.posexplode_outer(pairs).alias("_at", "_pair"))
    exploded = exploded.withColumn("_hash", F.xxhash64("_pair.w1", "_pair.w2"))
    t = F.broadcast(table)
    met = exploded.join(t, (F.col("_hash") == F.col("hash")) & (F.col("_pair.w1") == F.col("w1")) & (F.col("_pair.w2") == F.col("w2")), "left")
    # The first pair of every document stays without a match too, so that a document without votes keeps its row.
    met = met.filter(F.col("template").isNotNull() | F.coalesce(F.col("_at") == 0, F.lit(True)))
    return met.groupBy("_lic_row", "n_words", *kept, "template", "is_base", "label", "pairs", (F.col("_at") - F.col("at")).alias("diagonal")).agg(
        F.count("template").alias("votes"), F.min("_at").alias("first"), F.max("_at").alias("last"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask")
    )


def verified(near: Column) -> Column:
    """(votes, start, stop) of neighbouring diagonals: how many pairs of the template stand in its order, and where.

    Diagonals are taken in the order of their places in the text. Of each those pairs count that come after all counted ones in the
    template and in the text, so a pair that is there several times counts once, and pairs in another order do not.
    """
    by_place = F.array_sort(F.transform(near, lambda d: F.struct(d["first"].alias("first"), d["diagonal"].alias("diagonal"), d["mask"].alias("mask"))))
    nothing = F.struct(F.lit(0).alias("votes"), F.lit(-1).alias("pair"), F.lit(-1).alias("place"), F.lit(None).cast("int").alias("start"))
    top = lambda bits: F.length(F.bin(bits)) - 1

    def step(state: Column, d: Column) -> Column:
        after = F.greatest(state["pair"], state["place"] - d["diagonal"], F.lit(-1)) + 1
        bits = F.when(after > 62, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.call_function("shiftrightunsigned", d["mask"], after), after))
        lowest = top(bits.bitwiseAND(-bits))
        return F.when(bits == 0, state).otherwise(F.struct(
            (state["votes"] + F.bit_count(bits)).alias("votes"), top(bits).alias("pair"), (top(bits) + d["diagonal"]).alias("place"),
            F.coalesce(state["start"], lowest + d["diagonal"]).alias("start"),
        ))

    return F.aggregate(by_place, nothing, step, lambda s: F.struct(s["votes"].alias("votes"), s["start"].alias("start"), (s["place"] + 2).alias("stop")))


def scan(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), base: Mapping[str, str] = BASE,
    notices: Mapping[str, Sequence[str]] = NOTICES,
) -> DataFrame:
    """`keep` with RESULTS, and `spans`: the places found, as structs (label, start, end, cover), words counted from 0.

    Only documents' keys, counts and votes are shuffled. Diagonals of a document and template are sorted in one task, which looks at
    a few neighbours at a time; the row of a document holds the places found in it.
    """
    keep = [c for c in keep if c not in (*RESULTS, "spans")]
    kept = [f"_lic_{i}" for i in range(len(keep))]
    voted = votes(docs, text, templates(docs.sparkSession, base, notices), keep)
    # Every diagonal with those at most SHIFT away on either side, at most 2 * SHIFT + 1 of them.
    around = W.partitionBy("_lic_row", "template").orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    near = F.collect_list(F.struct("first", "diagonal", "mask")).over(around)
    seen = voted.withColumn("_near", F.when(~F.col("is_base"), near)).withColumn("_span", F.when(~F.col("is_base"), verified(F.col("_near"))))
    exact = F.col("is_base") & (F.col("votes") == F.col("pairs"))
    cover = F.when(F.col("is_base"), exact.cast("double")).otherwise(F.col("_span.votes") / F.col("pairs"))
    # Of neighbouring diagonals that all find one place, that which finds most of it, the first of these, tells the span.
    beside = W.partitionBy("_lic_row", "template").orderBy("diagonal").rangeBetween(-2 * SHIFT, 2 * SHIFT)
    seen = seen.withColumn("_cover", cover).withColumn("_best", F.max(F.struct("_cover", (-F.col("diagonal")).alias("d"))).over(beside))
    told = F.when(F.col("is_base"), exact).otherwise((F.col("_cover") >= COVER) & (F.col("_best.d") == -F.col("diagonal")))
    start = F.when(F.col("is_base"), F.col("diagonal")).otherwise(F.col("_span.start"))
    stop = F.when(F.col("is_base"), F.col("diagonal") + F.col("pairs") + 1).otherwise(F.col("_span.stop"))
    span = F.struct(F.col("is_base"), start.alias("start"), stop.alias("end"), F.col("label"), F.col("_cover").alias("cover"))
    found = seen.groupBy("_lic_row", "n_words", *kept).agg(
        F.count_if(exact).alias("n_base"), F.min(F.when(exact, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("diagonal"))).cast("long").alias("last_word"), F.collect_set(F.when(exact, F.col("label"))).alias("_base"),
        F.collect_set(F.when(told, F.col("label"))).alias("_every"), F.coalesce(F.max("_cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(told, span))).alias("_spans"),
    )
    return found.select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"), F.array_join(F.array_sort("_every"), ",").alias("labels"), "score",
        F.transform("_spans", lambda s: F.struct(s["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"), s["cover"].alias("cover"))).alias("spans"),
    )
