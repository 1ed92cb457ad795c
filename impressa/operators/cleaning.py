"""Row filters by id tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators.joins import spread_join
from impressa.operators.ordering import number_rows
from impressa.session import materialize

# Up to this many ids a sort with a limit keeps only that many rows per task.
_LIMIT_ROWS = 100_000
# Id tables of one column with at most this many rows are sent to every task.
_SMALL_TABLE_ROWS = 100_000


def _lookup(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with a one-column id table, by its counted size."""
    [id_column] = ids.columns
    if ids.count() <= _SMALL_TABLE_ROWS:
        return df.join(F.broadcast(ids), id_column, how)
    spread_by = next((c for c in df.columns if c != id_column), id_column)
    return spread_join(df, ids, id_column, spread_by, how)


def remove_ids(df: DataFrame, *deleted: DataFrame) -> DataFrame:
    """Drop the rows whose id is in one of the one-column id tables, e.g. users, then items."""
    for ids in deleted:
        df = _lookup(df, ids, "left_anti")
    return df


def keep_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in the one-column id table, each once."""
    return _lookup(df, ids, "left_semi")


def first_ids(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """The first n distinct ids in id order."""
    ids = df.select(id_column).distinct()
    if n <= _LIMIT_ROWS:
        return ids.orderBy(id_column).limit(n)
    return number_rows(ids, [id_column], "_i").filter(F.col("_i") < n).select(id_column)


def sample_first(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """All rows of the first n ids."""
    return keep_ids(df, materialize(first_ids(df, id_column, n)))
