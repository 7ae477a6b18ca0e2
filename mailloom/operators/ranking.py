"""Consecutive numbers over sorted data without a one-task window, a global sort or a stored copy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEVEL, _SIDE, _ROWS, _BEFORE = "__level", "__side", "__rows", "__before"


def text_levels(column: str, lengths: Iterable[int]) -> list[Column]:
    """Prefixes of a text, short ones first."""
    return [F.substring(column, 1, n) for n in sorted(lengths)]


def whole_levels(column: str, bits: Iterable[int] = (16,)) -> list[Column]:
    """A whole number without so many of its low bits, coarse ones first."""
    return [F.shiftright(F.col(column).cast("bigint"), n) for n in sorted(bits, reverse=True)]


def _rows_before(counts: DataFrame, group: list[str], levels: list[str]) -> DataFrame:
    """For each cell (group and all levels) the number of rows of its group in earlier cells."""
    stages = []
    for depth in range(len(levels), 0, -1):
        path, parent = [*group, *levels[:depth]], [*group, *levels[: depth - 1]]
        earlier = Window.partitionBy(*parent).orderBy(levels[depth - 1]).rowsBetween(Window.unboundedPreceding, -1)
        stages.append(counts.select(*path, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE)))
        counts = counts.groupBy(*parent).agg(F.sum(_ROWS).alias(_ROWS))
    before = stages.pop()
    for depth, finer in enumerate(reversed(stages), 1):
        above = [*group, *levels[:depth]]
        before = _beside(finer, before, above).select(*above, levels[depth], (F.col(_BEFORE) + F.col(_SIDE)).alias(_BEFORE))
    return before


def _beside(left: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Add the count of each row's cell as a side column; null keys are keys."""
    right = cells.select(*[F.col(c).alias(f"__k_{c}") for c in keys], F.col(_BEFORE).alias(_SIDE))
    same = F.lit(True)
    for c in keys:
        same = same & left[c].eqNullSafe(right[f"__k_{c}"])
    return left.join(right, same)


def with_position(
    df: DataFrame,
    order_by: list[str],
    group_by: list[str] | None = None,
    levels: Sequence[Column] = (),
    name: str = "position",
) -> DataFrame:
    """Add the zero-based position of each row within its group.

    Group and order columns must be unique together. `levels` cut a group into cells that follow each other: sorted in
    the given order, the rows must also be sorted by the levels, as they are by prefixes of the first order column, then
    that column, then prefixes of the second. A row's position is its place in its cell, by one hash exchange and a
    sort, and the rows in earlier cells, from counts that go up level by level. No task sorts more rows than a cell has
    or sums more counts than a level has below one value of the level above, so levels decide how far a group that holds
    most rows is spread. Without levels a whole group is sorted in one task. Nothing runs before the result is used.
    """
    group = list(group_by or [])
    if not group and not levels:
        raise ValueError("positions over all rows need levels")
    names = [f"{_LEVEL}{i}" for i in range(len(levels))]
    cells = df.withColumns(dict(zip(names, levels))) if levels else df
    path = [*group, *names]
    place = F.row_number().over(Window.partitionBy(*path).orderBy(*order_by)).cast("bigint") - 1
    placed = cells.withColumn(name, place)
    if not levels:
        return placed
    counts = cells.groupBy(*path).agg(F.count("*").alias(_ROWS))
    joined = _beside(placed, _rows_before(counts, group, names), path)
    return joined.select(*df.columns, (F.col(name) + F.col(_SIDE)).alias(name))


def assign_chunks(df: DataFrame, n: int, order_by: list[str], levels: Sequence[Column]) -> DataFrame:
    """Number consecutive groups of `n` rows from 0 in the given order; see `with_position` for the levels."""
    return with_position(df, order_by, levels=levels).withColumn(
        "chunk_no", F.floor(F.col("position") / F.lit(n)).cast("bigint")
    )


def chunk_report(chunks: DataFrame, accepted: Column) -> DataFrame:
    """Rows sent and accepted per chunk."""
    return chunks.groupBy("chunk_no").agg(
        F.count("*").alias("sent"), F.count_if(accepted).alias("accepted")
    )
