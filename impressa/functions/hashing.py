"""Seeded hash of a row key that any SQL engine with md5 can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 60


def key_hash(seed: int, *keys: Column | str) -> Column:
    """Uniform integer in [0, 2^60) from the seed and the key, whatever the partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_as_string(k) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fraction_bound(fraction: float) -> int:
    """Hashes below the bound make up ``fraction`` of all keys."""
    return int(fraction * HASH_RANGE)


def _as_string(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def table_checksum(df: DataFrame) -> str:
    """A name for the content of a table: its columns and rows in any order, repeated rows counted.

    Two independent 64-bit sums over the rows; one aggregate, no shuffle of rows.
    """
    names = sorted(df.columns)
    rows = [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in names]) for seed in (1, 2)]
    half = 1 << 32
    parts = [(F.pmod(h, F.lit(half)), F.shiftright(h, 32)) for h in rows]
    sums = [F.coalesce(F.sum(p), F.lit(0)) for pair in parts for p in pair]
    counts = df.agg(F.count("*").alias("n"), *[c.alias(f"s{i}") for i, c in enumerate(sums)])
    kinds = F.lit(",".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names))
    return counts.select(F.md5(F.concat_ws(":", kinds, *counts.columns)).alias("name")).first()["name"]
