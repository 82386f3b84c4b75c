"""Corpora from CSV files, one source per group of documents.

Every loader returns the ORDER columns, the position of a row in its file, and `raw`.
`audit=True` keeps texts as written (no header decoding) and, for CSV, all columns.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexigauge.config import CSV_NULLS
from lexigauge.functions.clean import NOT_SPACE, decode_subject
from lexigauge.functions.exprs import small
from lexigauge.sources.scratch import materialize

ORDER = ("file", "row_no", "piece")
_SPLIT = ("file", "part_start", "row_no", "piece")
# Line ends that only Unicode-aware splitters know; the reader has split at the others.
_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def _position() -> list[Column]:
    # Inside one split, rows get growing numbers; the split's start orders the splits of a file. `_numbered` makes row numbers of them.
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part_start"),
        F.monotonically_increasing_id().alias("row_no"),
    ]


def _numbered(rows: DataFrame) -> DataFrame:
    """`row_no` as the number of the row in its file, from 0, however the file was split.

    A file is parsed once and its rows are written with their split and their number in it. How a file is split depends on the
    cores of the moment, so a second read may split it elsewhere; the written rows keep what the first one saw. The splits'
    offsets come from that table. There is a row per split, broadcast where there are few of them.
    """
    held = materialize(rows, "rows")
    splits = held.groupBy("file", "part_start").agg(F.min("row_no").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("part_start").rowsBetween(Window.unboundedPreceding, 0)
    base = materialize(splits.withColumn("_base", F.sum("_n").over(before) - F.col("_n") - F.col("_first")).drop("_n", "_first"), "splits")
    joined = held.join(small(base, base.count()), ["file", "part_start"])
    return joined.withColumn("row_no", F.col("row_no") + F.col("_base")).drop("part_start", "_base")


def _blank_if_null(value: Column) -> Column:
    return F.when(value.isin(*CSV_NULLS), F.lit("")).otherwise(F.coalesce(value, F.lit("")))


def _null_if_marked(value: Column) -> Column:
    return F.when(~value.isin(*CSV_NULLS), value)


def _csv(spark: SparkSession, path: str, needed: Sequence[str], multi_line: bool = True) -> DataFrame:
    """All columns as strings under the names of the header; files with another header than the first are an error."""
    reader = lambda: spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    names = reader().csv(path).columns  # reads the first lines only
    missing = [c for c in needed if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    schema = ", ".join(f"`{c}` string" for c in names)
    return reader().schema(schema).option("enforceSchema", False).csv(path)


def read_subject_body(
    spark: SparkSession, path: str, columns: Sequence[str] = ("subject", "body"), audit: bool = False
) -> DataFrame:
    """Quoted CSV with embedded newlines; text = subject, one blank, body. Columns are found by the names in the header.

    `columns` are the names of the two columns. A multi-line file is one task: keep such files small or
    land them as Parquet once.
    """
    first, second = columns
    df = _csv(spark, path, columns)
    subject = F.col(first)
    subject = _blank_if_null(subject) if audit else decode_subject(_null_if_marked(subject))
    raw = F.concat(subject, F.lit(" "), _blank_if_null(F.col(second)))
    kept = [_null_if_marked(F.col(c)).alias(c) for c in df.columns] if audit else []
    return _numbered(df.select(*_position(), F.lit(0).alias("piece"), raw.alias("raw"), *kept))


def read_text_column(
    spark: SparkSession, path: str, columns: Sequence[str] = ("text",), audit: bool = False, multi_line: bool = True
) -> DataFrame:
    """Quoted CSV with a text column, found by its name in the header. An audit keeps a missing text as null.

    Without line ends inside quotes, `multi_line=False` lets large files be split.
    """
    (text,) = columns
    df = _csv(spark, path, columns, multi_line)
    raw = _null_if_marked(F.col(text)) if audit else _blank_if_null(F.col(text))
    kept = [_null_if_marked(F.col(c)).alias(c) for c in df.columns if c != text] if audit else []
    return _numbered(df.select(*_position(), F.lit(0).alias("piece"), raw.alias("raw"), *kept))


def _without_first_lines():
    # Nested, so that it travels to the executors by value.
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pass batches on without the first line of each file; lines come in file order within a split."""
        import numpy as np

        previous = (None, None)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            files, starts = batch.column("file"), batch.column("part_start").to_numpy(zero_copy_only=False)
            codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            opens = np.empty(batch.num_rows, dtype=bool)
            opens[0] = (files[0].as_py(), int(starts[0])) != previous
            opens[1:] = (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])
            previous = (files[batch.num_rows - 1].as_py(), int(starts[-1]))
            yield batch.filter(pa.array(~(opens & (starts == 0))))

    return drop


def read_last_comma(spark: SparkSession, path: str) -> DataFrame:
    """Unquoted lines `text,label`: the text is all before the last comma; a line without one is all text.

    The first line of every file is its header; blank lines are skipped. Large files are split.
    """
    lines = spark.read.text(path).select(*_position(), "value")
    body = lines.mapInArrow(_without_first_lines(), lines.schema)
    return (
        _numbered(body.select(*_SPLIT[:3], "value"))
        .select("file", "row_no", F.posexplode(F.split("value", _LINE_ENDS)).alias("piece", "line"))
        .where(F.col("line").rlike(NOT_SPACE))
        .select(*ORDER, F.regexp_replace("line", r",[^,]*\z", "").alias("raw"))
    )


@dataclass(frozen=True)
class GroupFile:
    """One input: where it lies, how it is laid out, and which group its rows belong to."""

    path: str
    layout: str  # 'subject_body', 'last_comma' or 'text'
    grp: str
    origin: str
    y: int
    columns: tuple[str, ...] | None = None  # names of the columns to read, if not the usual ones


def read_group(spark: SparkSession, source: GroupFile, audit: bool = False) -> DataFrame:
    if source.layout == "last_comma":
        return read_last_comma(spark, source.path)
    reader = {"subject_body": read_subject_body, "text": read_text_column}[source.layout]
    return reader(spark, source.path, **({"columns": source.columns} if source.columns else {}), audit=audit)


def load_corpus(spark: SparkSession, sources: Sequence[GroupFile]) -> DataFrame:
    """All groups in the given order: (doc_id, raw, y, origin, grp, grp_order) and the file position.

    Class and origin come from the source, never from a label column in the file.
    """
    parts = [
        read_group(spark, s).select(
            # Numbers padded, so that the order of the strings is the order of the rows.
            F.concat_ws("#", "file", F.lpad(F.col("row_no").cast("string"), 15, "0"), F.lpad(F.col("piece").cast("string"), 6, "0")).alias("doc_id"),
            "raw",
            F.lit(s.y).alias("y"),
            F.lit(s.origin).alias("origin"),
            F.lit(s.grp).alias("grp"),
            F.lit(i).alias("grp_order"),
            *ORDER,
        )
        for i, s in enumerate(sources)
    ]
    return reduce(DataFrame.unionByName, parts)


def load_for_audit(spark: SparkSession, sources: Sequence[GroupFile]) -> DataFrame:
    """(grp, raw, row): texts as written, and every column of a row as one JSON string."""
    parts = []
    for s in sources:
        df = read_group(spark, s, audit=True)
        row = [c for c in df.columns if c not in ORDER]
        parts.append(df.select(F.lit(s.grp).alias("grp"), "raw", F.to_json(F.struct(*row)).alias("row")))
    return reduce(DataFrame.unionByName, parts)
