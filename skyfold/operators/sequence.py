"""Ordered-sequence building blocks that survive hot keys.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task; one
aircraft (or one log source) holding a third of all rows would then sit in a
single task.  These helpers split each key's sequence into *chunks* (a column
that never decreases along the order, e.g. ``floor(ts / width)``) and work in
up to three windows over one pass of the rows, without a join:

1. within (key, chunk): the local lag, last value or running sum;
2. over the boundary rows only (the first and last row of every chunk; all
   other rows stay spread by chunk): what the preceding chunks carry over;
3. within (key, chunk) again: the carry of the chunk's first row, for all rows.

The input is read once however many steps are chained, and a step's third and
the next step's first window share their partitioning.  With ``chunk=None``
the helpers are the plain single-window form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
MIN_CHUNK = -(2 ** 62)


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def with_chunk(df: DataFrame, chunk: Column | None) -> DataFrame:
    if chunk is None:
        return df.withColumn(CHUNK, F.lit(0).cast("long"))
    return df.withColumn(CHUNK, F.coalesce(chunk.cast("long"), F.lit(MIN_CHUNK)))


def _boundary_window(keys: list[str], order: list[str]):
    """Window 2: the boundary rows of a key in order; other rows apart, by chunk."""
    apart = F.when(F.col("_first") | F.col("_last"), F.lit(None).cast("long")).otherwise(F.col(CHUNK))
    return Window.partitionBy(*keys, apart).orderBy(CHUNK, *order)


def _local(df: DataFrame, keys: list[str], order: list[str], chunk: Column, extra) -> tuple[DataFrame, object]:
    """Window 1: ``extra(window)`` columns plus the marks of boundary rows."""
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    d = with_chunk(df, chunk)
    return d.select("*", (F.row_number().over(w) == 1).alias("_first"),
                    F.lead(F.lit(1)).over(w).isNull().alias("_last"), *extra(w)), w


def time_chunk(ts_col: str, width_seconds: int) -> Column:
    """Chunk id for a time-ordered sequence: ``floor(ts / width)`` (null -> first)."""
    return F.floor(F.col(ts_col) / F.lit(int(width_seconds)))


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    cols: Sequence[str], prefix: str = "prev_",
                    chunk: Column | None = None, ignore_nulls: bool = False) -> DataFrame:
    """Attach ``prefix+c`` = value of ``c`` on the preceding row of the key.

    ``order`` columns are ascending, nulls first; they must form a total order
    within a key.  ``ignore_nulls`` gives "last non-null value before this row"
    instead of "value on the previous row".
    """
    keys, order, cols = list(keys), list(order), list(cols)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        if ignore_nulls:
            wp = w.rowsBetween(Window.unboundedPreceding, -1)
            return df.select("*", *[F.last(c, ignorenulls=True).over(wp).alias(prefix + c) for c in cols])
        return df.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols])

    if not ignore_nulls:
        d, _ = _local(df, keys, order, chunk, lambda w: [F.lag(c).over(w).alias("_l_" + c) for c in cols])
        b = _boundary_window(keys, order)
        d = d.select("*", *[F.lag(c).over(b).alias("_p_" + c) for c in cols])
        return d.select(*df.columns, *[F.when(F.col("_first"), F.col("_p_" + c)).otherwise(F.col("_l_" + c))
                                       .alias(prefix + c) for c in cols])

    def values(w):
        before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
        return [e for c in cols for e in (F.last(c, ignorenulls=True).over(before).alias("_l_" + c),
                                          F.last(c, ignorenulls=True).over(upto).alias("_t_" + c))]

    d, w = _local(df, keys, order, chunk, values)
    b = _boundary_window(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.select("*", *[F.last(F.when(F.col("_last"), F.col("_t_" + c)), ignorenulls=True).over(b).alias("_p_" + c)
                        for c in cols])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", *[F.first("_p_" + c).over(upto).alias("_c_" + c) for c in cols])
    return d.select(*df.columns, *[F.coalesce(F.col("_l_" + c), F.col("_c_" + c)).alias(prefix + c) for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | None = None,
                out: str | None = None, chunk: Column | None = None,
                sums: dict[str, Column] | None = None) -> DataFrame:
    """Inclusive running sums per key along ``order`` (``value`` -> ``out``,
    or several at once via ``sums={out: value}`` sharing one pass).

    With a chunk column, each chunk is summed locally and offset by the totals
    of the preceding chunks.
    """
    keys, order = list(keys), list(order)
    sums = dict(sums or {})
    if value is not None:
        sums[out] = value
    names = list(sums)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(sums[n]).over(w).alias(n) for n in names])
    d = df.select("*", *[sums[n].alias("_v_" + n) for n in names])
    d, w = _local(d, keys, order, chunk, lambda w: [
        F.sum("_v_" + n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_l_" + n) for n in names])
    b = _boundary_window(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.select("*", *[F.sum(F.when(F.col("_last"), F.col("_l_" + n))).over(b).alias("_o_" + n) for n in names])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", *[F.first("_o_" + n).over(upto).alias("_c_" + n) for n in names])
    return d.select(*df.columns, *[F.coalesce(F.col("_l_" + n) + F.col("_c_" + n), "_l_" + n, "_c_" + n).alias(n)
                                   for n in names])


def materialize(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns computed exactly once per row.

    Parsers (``from_csv``, ``from_json``, ``try_parse_json``) referenced by
    several projections and filters would otherwise be re-evaluated per
    reference after the optimizer inlines them; a single-row generator
    (``inline`` over a one-element array) makes them plain attributes."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))
