"""Dense, gap-free numbering inside groups that stays parallel under skew.

``row_number() OVER (PARTITION BY topic, partition_id ...)`` puts a whole
topic-partition into one task.  Here rows are first cut into chunks of a
monotone ordering key, each chunk is ranked on its own and its size taken from the
same shuffled rows, and the sizes are prefix-summed per group (one row per chunk).
The largest task ranks one chunk, whatever the size of the group; how many rows that
is depends on the key: ``width`` for dense unique numbers, fewer for sparse ones.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import OFFSET_CHUNK


def chunk_of(order_col: str | Column, width: int = OFFSET_CHUNK) -> Column:
    """Chunk id of a non-negative integral ordering column."""
    c = F.col(order_col) if isinstance(order_col, str) else order_col
    return floor_div(c, width)


def floor_div(c: Column, width: int | Column) -> Column:
    """Floor of an integral column over a positive integer, exact for every BIGINT."""
    c, w = c.cast("bigint"), width if isinstance(width, Column) else F.lit(width).cast("bigint")
    return F.call_function("div", c - F.pmod(c, w), w)


def number_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    chunk: Column,
    out: str = "log_offset",
    base: DataFrame | None = None,
) -> DataFrame:
    """Add ``out`` = base of the group + (0-based rank of the row in its group).

    Every row gets a number: null groups are groups, rows with a null chunk or ordering
    value come first in their group.  ``chunk`` must be monotone non-decreasing in ``order_cols``.  ``base`` is
    an optional DataFrame ``(*group_cols, base BIGINT)`` giving the first number
    of each group (0 when absent); it has one row per group.
    """
    g = list(group_cols)
    # one shuffled frame: each chunk is ranked and counted in the same task, so every row is read once
    local = Window.partitionBy(*g, "_chunk").orderBy(*order_cols)
    ranked = df.withColumn("_chunk", chunk).withColumn("_rn", F.row_number().over(local))
    counts = ranked.groupBy(*g, "_chunk").agg(F.max("_rn").cast("bigint").alias("_n"))
    before = Window.partitionBy(*g).orderBy(F.col("_chunk").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*g, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if base is not None:
        starts = null_safe_join(starts, base.select(*g, F.col("base").alias("_base")), g, "left") \
            .select(*g, "_chunk", (F.col("_start") + F.coalesce("_base", F.lit(0))).alias("_start"))
    cols = [c for c in df.columns if c != out]
    return (null_safe_join(ranked, starts, [*g, "_chunk"])
            .select(*cols, (F.col("_start") + F.col("_rn") - 1).cast("bigint").alias(out)))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; key columns come from the left side."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        eq = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])
