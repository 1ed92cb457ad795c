"""Category indexes and one-hot entries in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators.joins import hot_keys, spread_join
from impressa.operators.ordering import number_rows


def _cells(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """One row (column, value) per row and category column; nulls have none."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def category_indexes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, index) of category columns: the fitted encoding, in one pass.

    Values are numbered from 0 by falling frequency, ties in value order.
    """
    counts = _cells(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    numbered = number_rows(counts, ["column", F.desc("n"), "value"], "row")
    # One row per category column.
    starts = numbered.groupBy("column").agg(F.min("row").alias("start"))
    return numbered.join(F.broadcast(starts), "column").select(
        "column", "value", "n", (F.col("row") - F.col("start")).alias("index")
    )


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(value, n, index) of one category column."""
    return category_indexes(df, [column]).drop("column")


def one_hot_entries(df: DataFrame, row_id: str, columns: list[str], indexes: DataFrame) -> DataFrame:
    """(row id, column, index, value 1.0) of each row and category column.

    Unseen and null values have no entry, which is the all-zero encoding.
    """
    cell = F.struct("column", "value").alias("cell")
    lookup = indexes.select(cell, "n", "index")
    cells = _cells(df, columns, row_id).select(row_id, cell)
    # The fitted counts tell which values are frequent.
    hot = hot_keys(lookup, "cell", weight="n")
    joined = spread_join(cells, lookup.drop("n"), "cell", row_id, hot=hot)
    return joined.select(row_id, "cell.column", "index", F.lit(1.0).alias("value"))
