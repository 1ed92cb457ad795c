"""Bootstrap samples without numbering the table: draws are split down a tree of hash ranges.

The hash of a row's key puts it into one of 2^bits ranges. The n draws fall to the ranges by an exact
multinomial: at every node of the binary tree over them, those of the left half are a binomial number
with the share of rows that lie there. A node's number depends on the seed and the node alone, so each
range walks its own path from the root and all ranges agree. Inside a range rows are drawn by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from impressa.functions.hashing import key_hash
from impressa.operators.ordering import running_totals
from impressa.session import materialize

# Rows that a hash range holds on average, and draws that are unfolded from one row.
RANGE_ROWS = 50_000
DRAW_RUN = 1 << 14
_HASH_BITS = 60


def _range_of(seed: int, key: str, bits: int) -> Column:
    return F.shiftright(key_hash(seed, key), _HASH_BITS - bits)


def _share_of_draws(n: int, seed: int):
    """Draws of a leaf out of the (level, node, rows, left, to_left) of the nodes above it."""

    @F.pandas_udf("bigint")
    def share(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in paths:
            draws = np.full(len(batch), n, dtype=np.int64)
            for i, path in enumerate(batch):
                for step in path:
                    if not draws[i]:
                        break
                    chance = np.random.default_rng([seed, step["level"], step["node"]])
                    left = chance.binomial(draws[i], step["left"] / step["rows"])
                    draws[i] = left if step["to_left"] else draws[i] - left
            yield pd.Series(draws)

    return share


def range_draws(sizes: DataFrame, bits: int, n: int, seed: int) -> DataFrame:
    """(range, rows, draws) of the hash ranges (range, rows); the draws add up to n."""
    if not bits:
        return sizes.withColumn("draws", F.lit(n).cast("bigint"))
    level = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("level")
    steps = sizes.select("range", "rows", level).select(
        "*",
        F.expr(f"shiftright(range, {bits} - level)").alias("node"),
        (F.expr(f"shiftright(range, {bits} - level - 1)") % 2 == 0).alias("to_left"),
    )
    nodes = steps.groupBy("level", "node").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("to_left"), F.col("rows")).otherwise(0)).alias("left"),
    )
    step = F.struct("level", "node", nodes["rows"].alias("rows"), "left", "to_left")
    paths = (
        steps.withColumnRenamed("rows", "held")
        .join(nodes, ["level", "node"])
        .groupBy("range")
        .agg(F.first("held").alias("rows"), F.array_sort(F.collect_list(step)).alias("path"))
    )
    return paths.select("range", "rows", _share_of_draws(n, abs(seed))("path").alias("draws"))


def bootstrap_keys(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly n draws with replacement out of the rows of ``df``: (draw, key), draws from 0 to n - 1.

    ``key`` tells rows apart and is not null. The draws do not depend on the partitioning. There is no
    global order: keys are shuffled by hash range and sorted inside it; only the table of ranges, one
    row for RANGE_ROWS rows, is summed up in order.
    """
    total = df.count()
    if not total:
        raise ValueError("cannot draw from an empty table")
    bits = max(0, ((total - 1) // RANGE_ROWS).bit_length())
    keys = df.select(F.col(key), _range_of(seed, key, bits).alias("range"))
    sizes = materialize(keys.groupBy("range").agg(F.count("*").alias("rows")))
    drawn = materialize(range_draws(sizes, bits, n, seed))
    upto = running_totals(drawn.filter("draws > 0"), ["range"], ["draws"])
    # Draws are unfolded in runs, as a range of few rows may hold any number of them.
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("draws") - 1, F.lit(DRAW_RUN).cast("bigint")))
    runs = upto.select("range", "rows", "draws", (F.col("cum_draws") - F.col("draws")).alias("before"), first.alias("run"))
    last = F.least(F.col("run") + DRAW_RUN, F.col("draws")) - 1
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = runs.repartition(tasks, "range", "run").select(
        "range", "rows", F.explode(F.sequence(F.col("before") + F.col("run"), F.col("before") + last)).alias("draw")
    )
    places = draws.select("draw", "range", F.pmod(key_hash(seed + 1, "draw"), F.col("rows")).alias("place"))
    inside = Window.partitionBy("range").orderBy(key_hash(seed, key), key)
    placed = keys.withColumn("place", (F.row_number().over(inside) - 1).cast("bigint"))
    return places.join(placed, ["range", "place"]).select("draw", key)


def bootstrap(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly n rows drawn with replacement; ``draw`` tells repeats of a row apart."""
    return df.join(materialize(bootstrap_keys(df, n, seed, key)), key)
