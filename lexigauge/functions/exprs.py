"""Small column helpers."""

from pyspark.sql import Column, DataFrame, functions as F

from lexigauge.config import BROADCAST_ROWS


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    Binding through a one-element array keeps the optimizer from copying an expensive
    expression into every place (or every lambda step) that uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even (0.35 -> 0.3, 2.675 -> 2.67)."""
    return F.replace(F.format_number(value.cast("double"), digits), F.lit(","), F.lit("")).cast("double")


def percent(share: Column) -> Column:
    return round_half_even(100 * share, 1)


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast `df` when its declared row bound is small; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def unpack(entries: Column) -> Column:
    """One row per struct of an array, a column per field.

    The outer form keeps the optimizer from adding a "size > 0" filter that computes `entries` a second
    time; callers drop the all-null row of an empty array by a join or a filter.
    """
    return F.inline_outer(entries)
