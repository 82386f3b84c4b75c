"""Byte-level BPE encoding and decoding by a rank file.

Encoding: a text is cut into the pattern's matches. In each task DuckDB encodes the distinct matches that it has not seen yet: a
recursive query unnests their tokens into rows of positions, joins neighbouring pairs with the table of merges and contracts in
every word its leftmost pair of least rank, until no word has a pair that merges. A match that is itself a token is that token.
Decoding: DuckDB joins token positions with the vocabulary and aggregates their bytes in order. Equal runs of tokens
between two word starts are decoded once, and a document is put together from its runs.

Nothing is shuffled; a task holds one Arrow batch and dictionaries of bounded size. Words of more than LONG_WORD bytes, whose
contraction one pair at a time would be quadratic, take the same merges in the same order from a heap.

Defined cases: null and empty texts have no ids and decode to no bytes; null or empty ids decode to no bytes; an id outside the
vocabulary is an error; repeated rows are encoded alike; further columns are returned as they are, but for those named like a
result, which are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import add_columns, give_back, pieces_of

LONG_WORD = 256
#: Entries of a table of runs before it is cut back to those met more than once.
CACHE = 300_000
#: Bytes or ids that are looked through for equal runs at once.
SLICE = 400_000
#: Words that DuckDB encodes at once.
QUERY_WORDS = 8_000

_ENCODE = """
WITH RECURSIVE steps(step, word, ids) AS (
    SELECT 0, word, ids FROM words
  UNION ALL
    SELECT s.step + 1, s.word,
           list_concat(list_append(s.ids[:(b.best & 65535) - 1], (b.best >> 16)::INTEGER), s.ids[(b.best & 65535) + 2:])
    FROM steps s JOIN (
        SELECT p.word, min((m.merged::BIGINT << 16) + p.pos) AS best
        FROM (SELECT word, generate_subscripts(ids, 1) AS pos, unnest(ids) AS l, unnest(ids[2:]) AS r FROM steps) p
        JOIN merges m ON m.pair = (p.l::BIGINT << 32) + p.r
        GROUP BY p.word) b ON b.word = s.word
)
SELECT arg_max(ids, step) AS ids FROM steps GROUP BY word ORDER BY word
"""
_DECODE = """
SELECT string_agg(bytes, '') AS bytes FROM (
    SELECT run, pos, bytes
    FROM (SELECT run, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM runs) JOIN vocabulary USING (id)
    ORDER BY run, pos)
GROUP BY run ORDER BY run
"""  # One thread aggregates the rows in the order of the sort; a sort per run would cost five times as much.


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """A vocabulary with its DuckDB tables; one per worker process."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32) + right)
                    merged.append(rank)
        self._table("merges", pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())}))
        self._table("vocabulary", pa.table({
            "id": pa.array(self.ranks.values(), pa.int32()), "bytes": [t.decode("latin-1") for t in self.ranks],
        }))
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.opens = np.zeros(max(self.ranks.values()) + 1, bool)
        self.opens[[rank for token, rank in self.ranks.items() if token.startswith(b" ")]] = True
        self.valid = np.zeros(len(self.opens), bool)
        self.valid[list(self.ranks.values())] = True
        self.pieces = RunTable(np.uint8, np.int32, self._encode_runs)
        self.runs = RunTable(np.int32, np.uint8, self._decode_runs)

    def _table(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"CREATE TABLE {name} AS FROM given")
        self.db.unregister("given")

    def _query(self, sql: str, name: str, table: pa.Table) -> pa.Table:
        self.db.register(name, table)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as the bytes of 32-bit integers."""
        out: list[bytes | None] = [None] * len(words)
        short = []
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[i] = np.int32(rank).tobytes()
            elif len(word) > LONG_WORD:
                out[i] = np.array(heap_merge([self.of_byte[b] for b in word], word, self.ranks), np.int32).tobytes()
            else:
                short.append(i)
        for first in range(0, len(short), QUERY_WORDS):
            some = short[first : first + QUERY_WORDS]
            offsets = np.concatenate([[0], np.cumsum([len(words[i]) for i in some])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.of_byte[np.frombuffer(b"".join(words[i] for i in some), np.uint8)]))
            found = self._query(_ENCODE, "words", pa.table({"word": np.arange(len(some), dtype=np.int32), "ids": ids}))["ids"].combine_chunks()
            flat, ends = np.ascontiguousarray(found.values.to_numpy(), np.int32).tobytes(), found.offsets.to_numpy()
            for i, a, b in zip(some, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                out[i] = flat[4 * a : 4 * b]
        return out

    def _encode_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs, and how many each has."""
        texts = [r.decode() for r in runs]
        # Of runs that start with a space, those that do not end in one can be matched one behind the other.
        apart = [i for i, t in enumerate(texts) if t[0] == " " and not t[-1].isspace()]
        found = self.pattern.findall("".join([texts[i] for i in apart]))
        rest = {i: self.pattern.findall(t) for i, t in enumerate(texts) if t[0] != " " or t[-1].isspace()}
        words = list(set(found).union(*rest.values()))
        ids = dict(zip(words, self.encode_words([w.encode() for w in words]), strict=True))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        stops = np.searchsorted(ends, np.cumsum([len(texts[i]) for i in apart])).tolist()
        made = [b""] * len(runs)
        first = 0
        for i, stop in zip(apart, stops, strict=True):
            made[i] = ids[found[first]] if first == stop else b"".join([ids[w] for w in found[first : stop + 1]])
            first = stop + 1
        for i, matches in rest.items():
            made[i] = b"".join([ids[w] for w in matches])
        return np.frombuffer(b"".join(made), np.int32), np.array([len(m) // 4 for m in made], np.int64)

    def _decode_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of runs of ids, and how many each has."""
        offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in runs])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(runs), np.int32)))
        found = self._query(_DECODE, "runs", pa.table({"run": np.arange(len(runs), dtype=np.int32), "ids": ids}))
        made = [b.encode("latin-1") for b in found["bytes"].to_pylist()]
        return np.frombuffer(b"".join(made), np.uint8), np.array([len(b) for b in made], np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each text's ids start and the last ones end.

        A text is cut into runs where the pattern never matches across: before a space that follows no white space, between
        an ASCII letter and other ASCII that is no letter or digit, and between a single line end and a letter.
        """
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        kind = _KIND[flat]
        opens = kind == _SPACE
        if len(flat) > 2:
            opens[1:] &= ~_WHITE[flat[:-1]]
            opens[2:] &= ~(_WHITE_LAST[flat[1:-1]] & _WHITE_BEFORE[flat[:-2]])
            opens[1:] |= (kind[:-1] == _LETTER) & (kind[1:] >= _MARK)
            opens[2:] |= (flat[1:-1] == 10) & (kind[2:] == _LETTER) & (kind[:-2] > 0) & ~_WHITE[flat[:-2]]
        opens[ends[:-1][ends[:-1] < len(flat)]] = True
        ids, counts, at = self.pieces.replace(flat, np.append(np.flatnonzero(opens), len(flat)), ends)
        return ids, np.concatenate([[0], np.cumsum(counts)])[at]

    def decode(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the lists flat[ends[i]:ends[i + 1]] one behind the other, and where each list's bytes start and end."""
        if len(flat) and not (flat.min() >= 0 and flat.max() < len(self.valid) and self.valid[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        opens = self.opens[flat]
        opens[ends[:-1][ends[:-1] < len(flat)]] = True
        data, counts, at = self.runs.replace(flat, np.append(np.flatnonzero(opens), len(flat)), ends)
        return data, np.concatenate([[0], np.cumsum(counts)])[at]


class RunTable:
    """Runs of numbers and what each is replaced by, found by hash and compared in full."""

    def __init__(self, key: type, value: type, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.key, self.value, self.make = key, value, make
        self._set(*[np.zeros(0, t) for t in (np.uint64, np.int64, key, np.int64, value, np.int64)])

    def _set(self, hashes, key_sizes, keys, counts, values, uses) -> None:
        """Keep entries in the order of their hashes. `counts` are the sizes of the values."""
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.key_sizes, self.counts, self.uses = hashes[order], key_sizes[order], counts[order], uses[order]
        self.keys, self.values = spread(keys, key_sizes, order), spread(values, counts, order)
        self.key_starts = np.cumsum(self.key_sizes) - self.key_sizes

    def _add(self, hashes: np.ndarray, key_sizes: np.ndarray, keys: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > CACHE:  # entries met once since the last time go
            often = np.flatnonzero(self.uses > 0)
            if len(often) + len(hashes) > CACHE:
                often = often[:0]
            kept = (self.hashes[often], self.key_sizes[often], spread(self.keys, self.key_sizes, often), self.counts[often],
                    spread(self.values, self.counts, often), np.zeros(len(often), np.int64))
        else:
            kept = (self.hashes, self.key_sizes, self.keys, self.counts, self.values, self.uses)
        new = (hashes, key_sizes, keys, counts, values, np.zeros(len(hashes), np.int64))
        self._set(*[np.concatenate(pair) for pair in zip(kept, new, strict=True)])

    def replace(self, flat: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values of all runs one behind the other, their sizes, and the first run of each list that starts at `ends`."""
        values, counts = [np.zeros(0, self.value)], [np.zeros(0, np.int64)]
        for lo, hi in _slices(bounds):
            v, c = self._slice(flat[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
            values.append(v)
            counts.append(c)
        return np.concatenate(values), np.concatenate(counts), np.searchsorted(bounds, ends)

    def _slice(self, part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, first, place = distinct_runs(part, bounds)
        starts, sizes = bounds[first], bounds[first + 1] - bounds[first]
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        taken = known.copy()
        known[known] = self.key_sizes[at[known]] == sizes[known]
        inside = np.repeat(np.arange(len(hashes)), sizes * known)
        offset = np.arange(len(inside)) - np.repeat(np.cumsum(sizes * known) - sizes * known, sizes * known)
        differs = self.keys[self.key_starts[at[inside]] + offset] != part[starts[inside] + offset]
        known[inside[differs]] = False
        self.uses[at[known]] += 1
        new = np.flatnonzero(~known)
        keys = spread_at(part, starts[new], sizes[new])
        data, stops = keys.tobytes(), (np.concatenate([[0], np.cumsum(sizes[new])]) * keys.itemsize).tolist()
        made, made_counts = self.make([data[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]) if len(new) else (np.zeros(0, self.value), np.zeros(0, np.int64))
        counts = np.zeros(len(hashes), np.int64)
        counts[known], counts[new] = self.counts[at[known]], made_counts
        old = spread(self.values, self.counts, at[known])
        # Values of known and of new runs side by side, then in the order of the runs.
        table = np.concatenate([old, made])
        where = np.zeros(len(hashes), np.int64)
        sizes_known, sizes_new = counts[known], made_counts
        where[known] = np.cumsum(sizes_known) - sizes_known
        where[new] = len(old) + np.cumsum(sizes_new) - sizes_new
        out = spread_at(table, where[place], counts[place])
        if len(new):
            pick = np.flatnonzero(~taken[new])  # a run that shares its hash with one kept is made anew each time
            self._add(hashes[new][pick], sizes[new][pick], spread(keys, sizes[new], pick), made_counts[pick], spread(made, sizes_new, pick))
        return out, counts[place]


_LETTER, _MARK, _SPACE = 1, 2, 3
_KIND = np.array([
    _SPACE if b == 32 else _LETTER if b < 128 and chr(b).isalpha() else _MARK if b < 128 and not chr(b).isdigit() else 0 for b in range(256)
], np.uint8)


def _bytes(*values: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


# ASCII white space; the last byte, and the one before it, of white space outside ASCII (and of some other characters).
_WHITE = _bytes(9, 10, 11, 12, 13, 32)
_WHITE_LAST = _bytes(0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F)
_WHITE_BEFORE = _bytes(0xC2, 0x80, 0x81, 0x9A)

_STEP = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_STEP, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_STEP, _INVERSE):
        powers = np.full(SLICE + 1, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of runs with at most SLICE elements together; a longer run is a range of its own."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(int(np.searchsorted(bounds, bounds[lo] + SLICE, side="right")) - 1, lo + 1)
        yield lo, min(hi, n)
        lo = hi


def distinct_runs(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first run of each kind, and the kind of every run part[bounds[i]:bounds[i + 1]]. Equal hashes are compared in full."""
    begin, lengths = bounds[:-1], np.diff(bounds)
    powers, inverse = _powers()
    if len(part) > SLICE:  # one long run
        return np.array([xxhash.xxh64_intdigest(part.tobytes())], np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=sums[1:])
    hashes = (sums[begin + lengths] - sums[begin]) * inverse[begin] * np.uint64(_STEP) + lengths.astype(np.uint64)
    kinds, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    same = (lengths[first][place] == lengths).all() and (part[np.repeat(begin[first][place] - begin, lengths) + np.arange(len(part))] == part).all()
    if not same:  # two runs share a hash
        names: dict[bytes, int] = {}
        place = np.array([names.setdefault(part[a : a + n].tobytes(), len(names)) for a, n in zip(begin.tolist(), lengths.tolist(), strict=True)])
        _, first = np.unique(place, return_index=True)
        kinds = hashes[first]
    return kinds, first, place


def spread_at(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i] + sizes[i]] for every i, one behind the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def spread(values: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The lists with `lengths` in `values`, one list per entry of `place`, one behind the other."""
    return spread_at(values, (np.cumsum(lengths) - lengths)[place], lengths[place])


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def heap_merge(ids: list[int], word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Contract the leftmost pair of least rank until none merges. A heap holds the pairs, a linked list the tokens."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            stop = end[after[i]]
            rank = ranks.get(word[i:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop))

    for i in range(n):
        offer(i)
    ids = list(ids)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        right = after[i]
        alive[right] = False
        ids[i], end[i], after[i] = rank, stop, after[right]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [int(ids[i]) for i in range(n) if alive[i]]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add `ids`, the tokens of each whole text. `path`: a rank file that every executor can read."""

    def body(texts: list[bytes]) -> list:
        flat, ends = codec(path, pattern).encode(texts)
        return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]

    return add_columns(df, text, [(ids, T.ArrayType(T.IntegerType()))], body, keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Add `data`, the bytes of each list of ids."""
    kept = [c for c in (df.columns if keep is None else keep) if c != data]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(data, T.BinaryType())])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            sizes = batch.column(at).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in pieces_of(batch, sizes, SLICE):
                column = part.column(at)
                lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
                found, stops = codec(path, pattern).decode(flat, ends)
                made = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(found)])
                old = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*[x.cast(arrow.field(c).type) for x, c in zip(old, kept, strict=True)], made], schema=arrow)
        give_back()

    return df.select(*dict.fromkeys([*kept, ids])).mapInArrow(run, schema)
