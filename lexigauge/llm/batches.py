"""Arrow batches of texts inside a task: reading them, adding columns, hashing words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: ASCII white space: [\x20\x09-\x0D].
SPACE = b" \t\n\x0b\x0c\r"
#: The bytes of a code point after its first one.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Entries that a worker's dictionary of words may hold before it starts again.
CACHE_WORDS = 200_000
#: Bytes of text that a task works on at once, or one text.
PIECE_BYTES = 1_000_000


def give_back() -> None:
    """Return a worker's freed memory to the system at a task's end: workers outlive their stage, and the next one needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of the texts of a batch; null counts as empty."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def pieces_of(batch: pa.RecordBatch, lengths: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose lengths add up to `most`; a longer row is a run of its own."""
    ends, first = np.cumsum(lengths), 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        stop = max(int(np.searchsorted(ends, before + most, side="right")), first + 1)
        yield batch.slice(first, stop - first)
        first = stop


def text_pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    return pieces_of(batch, lengths.to_numpy(zero_copy_only=False).astype(np.int64), most)


def add_columns(
    df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], body: Callable[[list[bytes]], list], keep: list[str] | None = None
) -> DataFrame:
    """`df` with columns computed from the texts of each Arrow batch.

    `body` maps the texts of a batch to one array per field. Columns of `df` that have a new column's name are replaced;
    `keep` limits the columns of `df` that are returned.
    """
    names = [name for name, _ in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch, text, PIECE_BYTES):
                made = body(texts_of(part, text))
                old = [part.column(part.schema.get_field_index(c)) for c in kept]
                new = [x if isinstance(x, pa.Array) else pa.array(x, type=arrow.field(n).type) for n, x in zip(names, made, strict=True)]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip([*old, *new], arrow, strict=True)], schema=arrow)
        give_back()

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


class Hashes(dict):
    """Words to their unsigned 64-bit hashes, each computed once per worker while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = Hashes()
#: Lower case; everything in ASCII that is neither letter nor digit becomes a space.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def plain(text: bytes) -> bytes:
    """A text in lower case with spaces for all ASCII that is neither letter nor digit."""
    return text.translate(_PLAIN)


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text in order: runs of letters and digits, ASCII letters in lower case."""
    words = plain(text).split()
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
