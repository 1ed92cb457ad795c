"""Dense integer ids for string ids, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators.joins import hot_keys, spread_join
from impressa.operators.ordering import number_rows


# Column of an index with the number of rows that have the id.
ROWS = "n"


def dense_id_index(df: DataFrame, id_column: str, counted: bool = False) -> DataFrame:
    """(id, <id>_index): distinct ids numbered from 0 in id order.

    With ``counted`` also ``n``, the rows of the id: encoding and decoding find frequent ids there
    instead of looking through the rows that they join.
    """
    ids = df.groupBy(id_column).agg(F.count("*").alias(ROWS)) if counted else df.select(id_column).distinct()
    return number_rows(ids, [id_column], f"{id_column}_index")


def extend_id_index(index: DataFrame, df: DataFrame, id_column: str) -> DataFrame:
    """``index`` with the ids of ``df`` that it lacks, numbered after the largest number it has.

    Old ids keep their numbers, so that what was encoded with the old index stays readable; new ids follow
    in id order. Counts, where the index has them, add up. Null ids are left out. An empty index is begun
    at 0; the largest number, a single value, is all that the driver sees.
    """
    number = f"{id_column}_index"
    counted = ROWS in index.columns
    met = df.filter(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.count("*").alias(f"_{ROWS}"))
    new = met.join(index.select(id_column), id_column, "left_anti")
    start = index.agg(F.coalesce(F.max(number) + 1, F.lit(0))).first()[0]
    added = number_rows(new, [id_column], number).withColumn(number, F.col(number) + F.lit(start).cast("bigint"))
    if not counted:
        return index.select(id_column, number).unionByName(added.drop(f"_{ROWS}"))
    kept = index.join(met, id_column, "left").select(
        id_column, (F.col(ROWS) + F.coalesce(f"_{ROWS}", F.lit(0))).alias(ROWS), number
    )
    return kept.unionByName(added.withColumnRenamed(f"_{ROWS}", ROWS))


def encode_ids(df: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Replace each id column by its index; rows with an unknown id vanish.

    ``indexes`` maps id columns to index tables. A frequent id is spread by the other columns.
    """
    return _replace(df, indexes)


def decode_ids(
    df: DataFrame, indexes: dict[str, DataFrame], keep_index: bool = False
) -> DataFrame:
    """Replace each index column by its id, or add the id beside it."""
    lookups = {f"{id_column}_index": index for id_column, index in indexes.items()}
    return _replace(df, lookups, keep_index)


def _replace(df: DataFrame, lookups: dict[str, DataFrame], keep: bool = False) -> DataFrame:
    hot = {
        column: hot_keys(lookup, column, weight=ROWS) if ROWS in lookup.columns else hot_keys(df, column)
        for column, lookup in lookups.items()
    }
    for column, lookup in lookups.items():
        spread_by = next(c for c in df.columns if c != column)
        df = spread_join(df, lookup.drop(ROWS), column, spread_by, hot=hot[column])
        df = df if keep else df.drop(column)
    return df
