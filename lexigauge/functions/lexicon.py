"""Lexicon terms found at a word start; what follows the term does not matter."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexigauge import config

#: Parts that every term of a lexicon too large to broadcast is dealt in.
SALTS = 16


def has_term(low: Column, term: str) -> Column:
    # The plain substring test rejects most texts before any regex runs.
    return low.contains(term) & low.rlike(r"(?:^|[^a-z0-9])\Q" + term.replace(r"\E", r"\E\\E\Q") + r"\E")


def hits(low: Column, terms: Sequence[str]) -> Column:
    """The terms that occur, in lexicon order. For lexicons of up to some dozens of terms."""
    if not terms:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(has_term(low, t), F.lit(t)) for t in terms]))


def lexicon_matches(docs: DataFrame, lexicon: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """(doc_key, kind, term) for a lexicon of any size, given as a table (kind, term).

    A term can only be the beginning of the text that follows a word start, so cutting those beginnings to each length turns the
    theta-join "term occurs in text" into an equi-join. Beginnings are distinct per text before they are exploded.

    The lexicon is counted, up to one entry more than is broadcast. A larger one is dealt over the cluster by term, and so are the
    cuts, each term in SALTS parts: a third of all texts may have the same beginning.
    """
    lengths = lexicon.where(F.length("term") > 0).select(F.length("term").alias("n")).distinct()
    sizes = sorted(r["n"] for r in lengths.collect())  # a row per length that occurs
    if not sizes:
        return docs.select(doc_key, F.lit("").alias("kind"), F.lit("").alias("term")).where("false")
    beginnings = F.array_distinct(
        F.regexp_extract_all(
            F.col("low"), F.lit(rf"(?s)(?<![a-z0-9])(?=(.{{{sizes[0]},{sizes[-1]}}}))"), F.lit(1)
        )
    )
    cuts = F.array(*[F.when(F.length("_start") >= n, F.substring("_start", 1, n)) for n in sizes])
    starts = docs.select(doc_key, F.explode_outer(beginnings).alias("_start"))
    entries = lexicon.select("kind", "term")
    if lexicon.limit(config.BROADCAST_ROWS + 1).count() <= config.BROADCAST_ROWS:
        # Most beginnings already fail at the shortest length.
        openings = F.broadcast(lexicon.select(F.substring("term", 1, sizes[0]).alias("_opening")))
        likely = starts.withColumn("_opening", F.substring("_start", 1, sizes[0])).join(openings, "_opening", "left_semi")
        found = likely.select(doc_key, F.explode_outer(cuts).alias("term")).join(F.broadcast(entries), "term")
    else:
        part = F.pmod(F.xxhash64(doc_key), F.lit(SALTS)).alias("_part")
        dealt = entries.withColumn("_part", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
        # Cuts that several beginnings of a text share are one row; those of a text lie in one task, so this needs no shuffle.
        own = F.array_distinct(F.flatten(F.transform(beginnings, lambda s: F.array(*[F.when(F.length(s) >= n, F.substring(s, 1, n)) for n in sizes]))))
        found = docs.select(doc_key, part, F.explode_outer(own).alias("term")).filter("term IS NOT NULL").join(dealt, ["term", "_part"])
    return found.select(doc_key, "kind", "term").distinct()
