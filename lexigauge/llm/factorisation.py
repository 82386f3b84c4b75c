"""A factorisation machine for document quality.

Inputs are hashed words (square root of their frequency, scaled to length one), statistics of the text's structure cut into
steps, and metadata values. The score has a weight per input and the interactions of all pairs of inputs, each the inner product of two vectors
of low rank. By sum_{i<j} <v_i, v_j> x_i x_j = ((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2, that takes time linear in the inputs.

The fit runs on the driver over a bounded sample of labelled documents: the `sample` labelled keys of least hash. Every document is
scored whole, in Arrow batches; nothing but the sample's keys is shuffled.

Defined cases: null and empty texts have no words and are scored by their structure; null metadata is a value of its own; several
label rows of a document count as one with the largest label; null keys and labels teach nothing; if the sample has one class only or no
rows, all scores are the share of label 1 (one half without rows); repeated rows are scored alike; further columns are returned if named in `keep`, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexigauge.llm.batches import CONTINUATION, SPACE, texts_of, word_hashes
from lexigauge.sources.scratch import materialize

WORD_BITS, RANK, SAMPLE = 14, 8, 6000
EPOCHS, BATCH, RATE, RIDGE, SEED = 6, 128, 0.05, 1e-5, 7
#: Statistics of structure and the edges of their steps.
STEPS: dict[str, tuple[float, ...]] = {
    "words": (1, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000),
    "mean_word": (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 25),
    "upper": (0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8),
    "symbols": (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5),
    "marks": (0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.5),
    "digits": (0.0, 0.005, 0.01, 0.03, 0.1, 0.2, 0.4),
    "distinct": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.999),
    "same_as_next": (0.0, 0.002, 0.01, 0.03, 0.1, 0.3, 0.6),
    "line_words": (1, 3, 6, 10, 20, 40, 80, 160),
    "dup_lines": (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8),
}
_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_FIRST = dict(zip(STEPS, np.cumsum([0, *[len(e) + 1 for e in STEPS.values()]]).tolist(), strict=False))
N_STEPS = sum(len(e) + 1 for e in STEPS.values())
_BASE = 1 << WORD_BITS
#: Inputs: hashed words, then steps, then hashed metadata.
META_BITS = 10
INPUTS = _BASE + N_STEPS + (1 << META_BITS)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def structure(data: bytes, words: np.ndarray) -> list[int]:
    """One input per statistic: the step its value falls in."""
    n, chars = len(words), max(len(data.translate(None, SPACE + CONTINUATION)), 1)
    gone = lambda some: len(data) - len(data.translate(None, some))
    lines = [line for line in data.split(b"\n") if line.strip(SPACE)]
    values = {
        "words": n, "mean_word": chars / max(n, 1), "upper": gone(_UPPER) / chars, "symbols": gone(_SYMBOLS) / chars,
        "marks": gone(_MARKS) / chars, "digits": gone(_DIGITS) / chars, "distinct": len(np.unique(words)) / max(n, 1),
        "same_as_next": float((words[1:] == words[:-1]).sum()) / max(n, 1), "line_words": n / max(len(lines), 1),
        "dup_lines": (len(lines) - len(set(lines))) / max(len(lines), 1),
    }
    return [_BASE + _FIRST[name] + int(np.searchsorted(edges, values[name], side="left")) for name, edges in STEPS.items()]


def inputs(data: bytes, meta: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a document's inputs that are not zero."""
    words = word_hashes(data)
    slots, counts = np.unique(words >> np.uint64(64 - WORD_BITS), return_counts=True)
    values = np.sqrt(counts / max(len(words), 1))
    extra = structure(data, words) + [_BASE + N_STEPS + (xxhash.xxh64_intdigest(f"{i}={m}") >> (64 - META_BITS)) for i, m in enumerate(meta)]
    return np.concatenate([slots.astype(np.int64), extra]), np.concatenate([values, np.ones(len(extra))])


def raw_scores(model: Model, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Weights plus interactions of documents whose inputs lie one behind the other; a document starts at each of `starts`."""
    vx = model.factors[at] * x[:, None]
    sums = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
    return model.bias + np.add.reduceat(model.weights[at] * x, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS) -> Model:
    """AdaGrad on the logistic loss; classes weigh the same in sum to within a root."""
    if not len(y) or y.all() or not y.any():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-4), 1 - 1e-4)
        return Model(float(np.log(share / (1 - share))), np.zeros(INPUTS), np.zeros((INPUTS, 1)))
    rng = np.random.default_rng(SEED)
    w, v, bias = np.zeros(INPUTS), rng.normal(0, 0.05, (INPUTS, RANK)), 0.0
    gw, gv, gb = np.full(INPUTS, 1e-4), np.full((INPUTS, RANK), 1e-4), 1e-4
    weight = np.where(y > 0, np.sqrt((1 - y.mean()) / y.mean()), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(y), BATCH):
            pick = order[first : first + BATCH]
            sizes = np.array([len(rows[i][0]) for i in pick])
            at, x = np.concatenate([rows[i][0] for i in pick]), np.concatenate([rows[i][1] for i in pick])
            starts = np.cumsum(sizes) - sizes
            vx = v[at] * x[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            z = bias + np.add.reduceat(w[at] * x, starts) + 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            row = np.repeat(np.arange(len(pick)), sizes)
            used, place = np.unique(at, return_inverse=True)
            dw = np.bincount(place, weights=g[row] * x, minlength=len(used)) + RIDGE * w[used]
            part = (g[row] * x)[:, None] * (sums[row] - vx)
            dv = np.stack([np.bincount(place, weights=part[:, f], minlength=len(used)) for f in range(RANK)], axis=1) + RIDGE * v[used]
            gw[used] += dw**2
            gv[used] += dv**2
            gb += g.sum() ** 2
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            bias -= RATE * g.sum() / np.sqrt(gb)
    return Model(bias, w, v)


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", meta: Sequence[Column] = (),
    train_rows: Column | None = None, sample: int = SAMPLE,
) -> Model:
    """Fit on at most `sample` labelled documents. `train_rows` tells which label rows may teach; `meta` are columns of `docs` cast to strings."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.lit(True) if train_rows is None else train_rows))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_y"))
    picked = materialize(known.orderBy(F.xxhash64("_key", F.lit("sample")), "_key").limit(sample), "sample")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.array(*[m.cast("string") for m in meta]).cast("array<string>").alias("_meta"))
    met = rows.join(F.broadcast(picked), "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [inputs(t, [str(m) for m in ms or ()]) for t, ms in zip(texts_of(batch, "_text"), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(3), pa.array([a.astype(np.int32) for a, _ in made], pa.list_(pa.int32())), pa.array([x for _, x in made], pa.list_(pa.float64())),
            ], names=["_key", "_y", "at", "x"])

    kind = rows.schema["_key"].dataType.simpleString()
    shown = met.select("_key", "_text", "_meta", "_y").mapInArrow(run, f"_key {kind}, _y int, at array<int>, x array<double>")
    got = shown.dropDuplicates(["_key"]).orderBy("_key").toArrow()  # a row per key picked
    at, x = got["at"].combine_chunks(), got["x"].combine_chunks()
    made = [(at[i].values.to_numpy(), x[i].values.to_numpy()) for i in range(got.num_rows)]
    return train(made, got["_y"].to_numpy() > 0)


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",), meta: Sequence[Column] = (), threshold: float = 0.5
) -> DataFrame:
    """`keep` with `score` (0 to 1) and `predicted` (1 from `threshold` on)."""
    keep = [c for c in keep if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"), F.array(*[m.cast("string") for m in meta]).cast("array<string>").alias("_meta"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, metas = texts_of(batch, "_text"), batch.column(batch.num_columns - 1).to_pylist()
            out = []
            for first in range(0, len(texts), 500):
                made = [inputs(t, [str(m) for m in ms or ()]) for t, ms in zip(texts[first : first + 500], metas[first : first + 500], strict=True)]
                sizes = np.array([len(a) for a, _ in made])
                out.append(raw_scores(shared.value, np.concatenate([a for a, _ in made]), np.concatenate([x for _, x in made]), np.cumsum(sizes) - sizes))
            values = 1 / (1 + np.exp(-np.clip(np.concatenate(out), -40, 40)))
            old = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*old, pa.array(values), pa.array((values >= threshold).astype(np.int32))], schema=arrow)

    return rows.mapInArrow(run, schema)
