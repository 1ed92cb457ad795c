"""Equi-joins of a large table with a lookup table that stay balanced under frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.session import materialize

# A key is split into pieces of about this many rows: below it one task copes with it.
HOT_KEY_ROWS = 1_000_000
# At most this many keys can be split, since each holds more than this part of all rows.
_MAX_HOT_KEYS = 100_000


def hot_keys(
    df: DataFrame, key: str, weight: str | None = None, min_rows: int | None = None
) -> DataFrame | None:
    """(key, _salts) for keys with too many rows for one task, or None if there are none.

    Fewer than ``_MAX_HOT_KEYS`` rows by construction. ``weight`` names a column with the number
    of rows that each row of ``df`` stands for.
    """
    rows = F.sum(weight) if weight else F.count("*")
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("rows"))
    size = counts.agg(F.max("rows").alias("top"), F.sum("rows").alias("total")).first()
    piece = max(min_rows or HOT_KEY_ROWS, (size["total"] or 0) // _MAX_HOT_KEYS)
    if (size["top"] or 0) <= piece:
        return None
    pieces = F.ceil(F.col("rows") / piece).cast("int")
    return materialize(counts.filter(F.col("rows") > piece).select(key, pieces.alias("_salts")))


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    hot: DataFrame | None | str = "look",
    also_on: tuple[str, ...] = (),
) -> DataFrame:
    """Join ``facts`` with ``lookup`` on ``key``, with the rows of frequent keys split.

    Frequent keys get a salt from the hash of ``spread_by`` on the fact side; only their lookup
    rows are repeated, once per salt. Every fact row still meets the same lookup rows, so inner,
    left, semi and anti joins keep their meaning. Without a frequent key this is a plain join. The
    caller may pass the result of :func:`hot_keys` as ``hot``; ``also_on`` names further key columns.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if isinstance(hot, str):
        hot = hot_keys(facts, key)
    on = [key, *also_on]
    if hot is None:
        return facts.join(lookup, on, how)
    hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")
    salted = facts.join(hot, key, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    repeated = lookup.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), last))
    )
    joined = salted.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how)
    return joined.drop("_salt")


def join_predictions(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Rows that every model has scored, one column per model.

    Repeated keys (from sampling with replacement) are reduced to their mean first, which also
    keeps the joins one-to-one.
    """
    joined = None
    for model, df in tables.items():
        single = df.groupBy(*keys).agg(F.avg(model).alias(model))
        joined = single if joined is None else joined.join(single, keys)
    return joined


def join_labels(predictions: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Predictions with the labels of their keys; a repeated label row does not repeat them."""
    return predictions.join(labels.dropDuplicates(keys), keys)
