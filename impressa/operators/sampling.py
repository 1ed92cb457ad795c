"""Splits and samples by key hash: repeatable under any partitioning and after lost tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from impressa.functions.hashing import fraction_bound, key_hash
from impressa.operators.cleaning import keep_ids
from impressa.operators.ordering import number_rows
from impressa.session import materialize

# Cut points are searched in 2^16 equal ranges of the hash, and those in 2^16 finer ones, until the
# range that holds the cut has at most this many rows.
_HASH_BITS, _STEP_BITS = 60, 16
_RANGE_ROWS = 100_000


def in_fraction(fraction: float, seed: int, *keys: str) -> Column:
    """True for about ``fraction`` of the keys, always the same ones."""
    return key_hash(seed, *keys) < fraction_bound(fraction)


def split(df: DataFrame, fraction: float, seed: int, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts of about ``fraction`` and ``1 - fraction``."""
    first = in_fraction(fraction, seed, *keys)
    return df.filter(first), df.filter(~first)


def _range_of(hashed: DataFrame, bits: int, n: int) -> Row | None:
    """The range of the n-th lowest hash: its number, its rows, and the rows up to its end."""
    histogram = hashed.groupBy(F.shiftright("_h", bits).alias("_r")).agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    reached = histogram.withColumn("_upto", F.sum("_n").over(upto)).filter(F.col("_upto") >= n)
    return reached.orderBy("_r").first()


def lowest_n(df: DataFrame, n: int, seed: int, key: str) -> Column:
    """Condition true for exactly the n rows of ``df`` with the lowest (hash, key); key is unique.

    The n-th row is found from a histogram of the hash, refined within the range that holds it, and
    a look into a range of few rows, so neither n rows nor the table pass through one task.
    """
    if n <= 0:
        return F.lit(False)
    hashed = df.select(key, key_hash(seed, key).alias("_h"))
    needed, bits = n, _HASH_BITS
    while True:
        bits = max(0, bits - _STEP_BITS)
        reached = _range_of(hashed, bits, needed)
        if reached is None:
            return F.lit(True)
        needed -= reached["_upto"] - reached["_n"]
        hashed = hashed.filter(F.shiftright("_h", bits) == reached["_r"])
        if reached["_n"] <= _RANGE_ROWS or not bits:
            break
    last = hashed.orderBy("_h", key).limit(needed).agg(F.max(F.struct("_h", key)).alias("cut")).first()["cut"]
    h = key_hash(seed, key)
    return (h < last["_h"]) | ((h == last["_h"]) & (F.col(key) <= last[key]))


def split_fixed_size(df: DataFrame, n_test: int, seed: int, key: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``n_test`` test rows, or all rows if there are fewer."""
    chosen = lowest_n(df, n_test, seed, key)
    return df.filter(~chosen), df.filter(chosen)


def sample_cohort(df: DataFrame, id_column: str, n: int, seed: int) -> DataFrame:
    """All rows of n randomly chosen distinct ids."""
    ids = df.select(id_column).distinct()
    return keep_ids(df, materialize(ids.filter(lowest_n(ids, n, seed, id_column))))


def fold_number(folds: int, seed: int, *keys: str) -> Column:
    """Fold 0 .. folds-1 of a key."""
    return F.pmod(key_hash(seed, *keys), F.lit(folds)).cast("int")


def number_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, id): the row keys numbered from 0, for any number of bootstrap samples."""
    return materialize(number_rows(df.select(key), [key], "id"))


def bootstrap_keys(numbered: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly n draws with replacement: (draw, key)."""
    total = numbered.count()
    if not total:
        raise ValueError("cannot draw from an empty table")
    draws = numbered.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.pmod(key_hash(seed, "id"), F.lit(total)).alias("id")
    )
    return draws.join(numbered, "id").select("draw", key)


def bootstrap(
    df: DataFrame, n: int, seed: int, key: str, numbered: DataFrame | None = None
) -> DataFrame:
    """Exactly n rows drawn with replacement. ``draw`` tells repeats of a row apart."""
    numbered = number_keys(df, key) if numbered is None else numbered
    return df.join(materialize(bootstrap_keys(numbered, n, seed, key)), key)
