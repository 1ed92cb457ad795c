"""Shards of near neighbours in several metadata dimensions, by position on a Hilbert curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from impressa.operators.ordering import number_rows
from impressa.session import materialize


def text_number(text: Column, bytes_used: int = 6) -> Column:
    """A double that orders strings as their first UTF-8 bytes do; null stays null."""
    digits = F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, bytes_used)), 2 * bytes_used, "0")
    return F.conv(digits, 16, 10).cast("double")


def magnitude(number: Column) -> Column:
    """Length of a positive integer in bits: one step per doubling."""
    return F.length(F.bin(number)).cast("double")


# Steps of a dimension's range whose rows are counted to find the cells.
_STEPS = 1 << 16


def quantised(
    df: DataFrame, dimensions: dict[str, Column], bits: int, prefix: str = "_cell"
) -> DataFrame:
    """Add ``_cell0``, ``_cell1``, ...: each dimension cut into 2^bits cells by rank of its rows.

    Rows are counted in 65,536 equal steps of a dimension's range, and a step's cell follows from the
    middle rank of its rows, so that cells hold about equal numbers of rows and a frequent value has a
    cell of its own. The tables of steps are bounded by their number. Null falls into cell 0.
    """
    numbers = range(len(dimensions))
    bounds = df.agg(
        *[F.min(d).alias(f"_low{i}") for i, d in enumerate(dimensions.values())],
        *[F.max(d).alias(f"_high{i}") for i, d in enumerate(dimensions.values())],
    )
    steps = {}
    for i, dimension in enumerate(dimensions.values()):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        part = F.coalesce((dimension - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
        step = F.least(F.floor(part * _STEPS), F.lit(_STEPS - 1)).cast("int")
        steps[f"_step{i}"] = F.when(dimension.isNotNull(), step)
    stepped = df.join(F.broadcast(bounds)).select("*", *[c.alias(n) for n, c in steps.items()])
    counts = (
        stepped.select(F.posexplode(F.array(*steps)).alias("_of", "_step"))
        .filter(F.col("_step").isNotNull())
        .groupBy("_of", "_step")
        .agg(F.count("*").alias("_n"))
    )
    whole = Window.partitionBy("_of")
    ranked = counts.select(
        "_of",
        "_step",
        "_n",
        F.sum("_n").over(whole.orderBy("_step")).alias("_up_to"),
        F.sum("_n").over(whole).alias("_all"),
    )
    cell = F.expr(f"(2 * _up_to - _n) * {1 << bits} div (2 * _all)")
    cells = materialize(ranked.select("_of", "_step", cell.alias("_cell")))
    for i in numbers:
        own = cells.filter(F.col("_of") == i).select(
            F.col("_step").alias(f"_step{i}"), F.col("_cell").alias(f"{prefix}{i}")
        )
        stepped = stepped.join(F.broadcast(own), f"_step{i}", "left")
    placed = [F.coalesce(f"{prefix}{i}", F.lit(0)).cast("bigint").alias(f"{prefix}{i}") for i in numbers]
    return stepped.select(*df.columns, *placed)


def hilbert_index(df: DataFrame, cells: Sequence[str], bits: int, name: str) -> DataFrame:
    """Add the position of a cell on the Hilbert curve through a grid of 2^bits steps a side.

    The coordinates are turned level by level, from the coarsest bit to the finest: where a
    coordinate has the bit, the lower bits of the first are mirrored, else they are swapped. What
    results is the Gray code of the position. Each step is one projection over the last, so that
    no expression is written out twice.
    """
    n = len(cells)
    x = [f"_h{i}" for i in range(n)]
    df = df.select("*", *[F.col(c).alias(v) for c, v in zip(cells, x, strict=True)])
    first = F.col(x[0])
    for level in range(bits - 1, 0, -1):
        lower = F.lit((1 << level) - 1)
        for i in range(n):
            has = F.shiftright(x[i], level).bitwiseAND(F.lit(1)) == 1
            if i == 0:
                df = df.withColumn(x[0], F.when(has, first.bitwiseXOR(lower)).otherwise(first))
                continue
            swapped = first.bitwiseXOR(F.col(x[i])).bitwiseAND(lower)
            df = df.withColumns(
                {
                    x[0]: first.bitwiseXOR(F.when(has, lower).otherwise(swapped)),
                    x[i]: F.when(has, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swapped)),
                }
            )
    for i in range(1, n):
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    mirror = F.lit(0).cast("bigint")
    for level in range(bits - 1, 0, -1):
        has = F.shiftright(x[-1], level).bitwiseAND(F.lit(1)) == 1
        mirror = mirror.bitwiseXOR(F.when(has, F.lit((1 << level) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_mirror", mirror)
    position = F.lit(0).cast("bigint")
    for level in range(bits):
        for i in range(n):
            bit = F.shiftright(F.col(x[i]).bitwiseXOR(F.col("_mirror")), level).bitwiseAND(F.lit(1))
            position = position + F.shiftleft(bit, level * n + n - 1 - i)
    return df.withColumn(name, position).drop(*x, "_mirror")


def assign_shards(
    df: DataFrame,
    dimensions: dict[str, Column],
    shards: int,
    ties: Sequence[str | Column],
    bits: int = 4,
) -> DataFrame:
    """``df`` with ``curve`` (Hilbert index), ``shard`` and ``slot`` (position in the shard from 0).

    Rows are numbered along the curve, equal cells in the order of ``ties``, and the numbers are cut
    into ``shards`` runs whose lengths differ by one at most. Numbering sorts by range, so neither
    a frequent cell nor repeated rows fill a task; rows equal in all ties may swap places. An empty
    table gives no rows; with fewer rows than shards some shards stay empty.
    """
    cells = [f"_cell{i}" for i in range(len(dimensions))]
    placed = hilbert_index(quantised(df, dimensions, bits), cells, bits, "curve")
    numbered = number_rows(placed.select(*df.columns, "curve"), ["curve", *ties], "_row")
    rows = numbered.agg(F.count("*").alias("_rows"))
    return (
        numbered.join(F.broadcast(rows))
        .withColumn("_shard", F.expr(f"_row * {shards} div _rows"))
        .withColumn("_start", F.expr(f"(_shard * _rows + {shards - 1}) div {shards}"))
        .select(
            *df.columns,
            "curve",
            F.col("_shard").cast("int").alias("shard"),
            (F.col("_row") - F.col("_start")).alias("slot"),
        )
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write a folder per shard, rows in slot order; a shard is cut at ``maxRecordsPerFile``."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def shard_ranges(sharded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lowest and highest value of each column by shard: what a reader needs to skip shards."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *[F.min(c).alias(f"{c}_low") for c in columns],
        *[F.max(c).alias(f"{c}_high") for c in columns],
    )
