"""Words, word pairs and their counts inside one row: no shuffle is needed to count within a document."""

from collections.abc import Callable
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F

from lexigauge.functions.exprs import let


def tokens(low: Column) -> Column:
    """Runs of two or more ASCII letters or digits, in order."""
    return F.regexp_extract_all(low, F.lit("[a-z0-9]{2,}"), F.lit(0))


def with_pairs(words: Column) -> Column:
    """The words, then each pair of neighbours."""

    def build(w):
        n = F.size(w)
        pairs = F.zip_with(
            F.slice(w, F.lit(1), n - 1), F.slice(w, F.lit(2), n - 1), lambda a, b: F.concat(a, F.lit(" "), b)
        )
        return F.when(n > 1, F.concat(w, pairs)).otherwise(w)

    return let(words, build)


def terms(low: Column, words: Callable[[Column], Column] = tokens) -> Column:
    """Words and pairs; `words` makes an array of words of a text."""
    return with_pairs(words(low))


def run_lengths(values: Column) -> Column:
    """array<string> -> array<struct<term string, cnt double>>, one entry per distinct value, sorted by it.

    Sorting brings equal values together; an entry starts wherever the value changes and its
    count is the distance to the next start. Linear after the sort, so whole texts are no issue. Counts are
    doubles so that numeric features can join the same array (see operators.weights).
    """

    def from_sorted(s):
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: (i < n) & ((i == 0) | (F.get(s, i) != F.get(s, i - 1))),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(s, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), n) - start).cast("double").alias("cnt"),
                ),
            ),
        )

    return let(F.sort_array(values), from_sorted)


def _counting_udf():
    # Nested, so that it travels to the executors by value.
    @F.arrow_udf("array<struct<term string, cnt double>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ctypes

        import numpy as np
        import pyarrow.compute as pc

        most = 1_000_000  # bytes of text worked on at once, or one text
        empty, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        in_word = np.zeros(256, bool)
        in_word[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True

        def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
            """Document and string of every word: runs of two or more word bytes that do not cross the end of a text."""
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = texts.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
            bounds = bounds - bounds[0]
            inside = in_word[data]
            edges = bounds[(bounds > 0) & (bounds < len(data))]
            before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[edges] = after[edges - 1] = False
            start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
            long = stop - start > 1
            inside[start[~long]] = False
            start, stop = start[long], stop[long]
            ends = np.concatenate([[0], np.cumsum(stop - start)])
            found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
            return np.searchsorted(bounds[1:], start, side="right"), found

        def count(texts: pa.Array) -> pa.Array:
            doc, found = words_of(texts)
            coded = found.dictionary_encode()
            order = pc.sort_indices(coded.dictionary)
            names = coded.dictionary.take(order)
            n = len(names)
            rank = np.empty(n, np.int64)
            rank[order.to_numpy()] = np.arange(n)
            code = rank[coded.indices.to_numpy()]
            # A term is its first word and what follows that: nothing, or a blank and a second word. Blanks sort before word bytes,
            # so the numbers of terms are in the order of their strings.
            here = doc * (n * (n + 1))
            pair = np.flatnonzero(doc[1:] == doc[:-1])
            keys = np.sort(np.concatenate([here + code * (n + 1), here[pair] + code[pair] * (n + 1) + code[pair + 1] + 1]))
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            counts = np.diff(np.append(at, len(keys))).astype(np.float64)
            owner, term = np.divmod(keys[at], max(n * (n + 1), 1))
            first, second = np.divmod(term, n + 1)
            behind = pa.concat_arrays([pa.array([""], pa.large_string()), pc.binary_join_element_wise(empty, names, blank)])
            joined = pc.binary_join_element_wise(names.take(pa.array(first)), behind.take(pa.array(second)), empty)
            entries = pa.StructArray.from_arrays([joined.cast(pa.string()), pa.array(counts)], names=["term", "cnt"])
            return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)), entries)

        for batch in batches:
            texts = pc.fill_null(batch, "").cast(pa.large_string())
            ends, done = np.cumsum(pc.binary_length(texts).to_numpy()), 0
            while done < len(texts):
                stop = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + most, side="right")), done + 1)
                yield count(texts.slice(done, stop - done))
                done = stop
            if not len(texts):
                yield count(texts)
        # Workers outlive their stage, and the next one needs the memory.
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return counted


def term_counts(low: Column, words: Callable[[Column], Column] = tokens) -> Column:
    """array<struct<term string, cnt double>>, sorted by term: the words and pairs of a text with their numbers; empty for null.

    The usual words are cut and counted for a megabyte of texts at once, as bytes and numbers; a caller's own words in the row.
    """
    return _counting_udf()(low) if words is tokens else run_lengths(terms(low, words))


def alpha_words(low: Column) -> Column:
    """Distinct runs of three or more ASCII letters."""
    return F.array_distinct(F.regexp_extract_all(low, F.lit("[a-z]{3,}"), F.lit(0)))
