"""Numbering and running totals over a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from impressa.session import materialize

# monotonically_increasing_id() keeps the partition number above 33 bits of row position.
_POSITION_BITS = 33
_PART, _POSITION = "_part", "_position"


def _laid_out(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` range-partitioned and sorted, with partition number and position as stored values."""
    placed = df.orderBy(*order_by).withColumn("_row", F.monotonically_increasing_id())
    return materialize(placed).withColumns(
        {
            _PART: F.shiftright("_row", _POSITION_BITS),
            _POSITION: F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    ).drop("_row")


def _before(parts: DataFrame, names: Sequence[str], xors: Sequence[str] = ()) -> DataFrame:
    """Totals of all earlier parts. One row per part, so the unpartitioned window stays small."""
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = [(name, F.sum(name)) for name in names] + [(name, F.bit_xor(name)) for name in xors]
    return parts.select(
        F.col(_PART),
        *[F.coalesce(total.over(earlier), F.lit(0)).alias(f"_before_{name}") for name, total in totals],
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index"
) -> DataFrame:
    """Add a dense 0-based row number in the order given.

    One range shuffle; part sizes are added up on a table with one row per partition.
    """
    rows = _laid_out(df, order_by)
    sizes = rows.groupBy(_PART).agg(F.count("*").alias("size"))
    offsets = _before(sizes, ["size"])
    return rows.join(F.broadcast(offsets), _PART).select(
        *df.columns, (F.col("_before_size") + F.col(_POSITION)).cast("bigint").alias(name)
    )


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    values: Sequence[str],
    xors: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<value>``, the inclusive running total of each value column.

    ``xors`` names integer columns that are combined by exclusive or in place of a sum; they cannot
    overflow, and the value between two rows is the exclusive or of their totals.

    Aggregate to one row per order key first, so that a frequent key cannot fill a partition.
    """
    rows = _laid_out(df, order_by)
    totals = rows.groupBy(_PART).agg(
        *[F.sum(v).alias(v) for v in values], *[F.bit_xor(v).alias(v) for v in xors]
    )
    offsets = _before(totals, values, xors)
    within = (
        Window.partitionBy(_PART).orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = rows.select(
        "*",
        *[F.sum(v).over(within).alias(f"_within_{v}") for v in values],
        *[F.bit_xor(v).over(within).alias(f"_within_{v}") for v in xors],
    )
    return summed.join(F.broadcast(offsets), _PART).select(
        *df.columns,
        *[(F.col(f"_before_{v}") + F.col(f"_within_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"_before_{v}").bitwiseXOR(F.col(f"_within_{v}")).alias(f"cum_{v}") for v in xors],
    )


def zip_by_row_number(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
) -> DataFrame:
    """Pair the i-th row of one table with the i-th row of another, each in an explicit order."""
    return number_rows(left, left_order).join(number_rows(right, right_order), "row_index")


def top_k(df: DataFrame, group: str, order_by: Sequence[Column], k: int) -> DataFrame:
    """Best k rows per group with their rank from 1.

    Catalyst limits each group to k rows before the shuffle, so a large group costs k rows per task.
    """
    ranked = Window.partitionBy(group).orderBy(*order_by)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
