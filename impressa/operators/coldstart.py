"""Zero rows for ids that occur in the test part only, so that a factorisation knows them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators.ids import dense_id_index
from impressa.session import materialize
from impressa.sources.schemas import LABELS

# An index with at most this many rows (a string and a number each) is sent to every task.
_SMALL_INDEX_ROWS = 100_000


def missing_ids(train: DataFrame, test: DataFrame, id_column: str) -> DataFrame:
    """Distinct ids of test that train does not have.

    Both sides are reduced to distinct ids before they meet, so that a frequent id is one row.
    """
    return test.select(id_column).distinct().subtract(train.select(id_column).distinct())


def _numbered(ids: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    index = materialize(dense_id_index(ids, id_column))
    return index, index.count()


def _attach(slots: DataFrame, index: DataFrame, size: int, id_column: str) -> DataFrame:
    """Give slot i the id number i modulo ``size``.

    A small index is broadcast; over a larger one the slots of each id are few.
    """
    side = F.broadcast(index) if size <= _SMALL_INDEX_ROWS else index
    numbered = slots.withColumn(f"{id_column}_index", F.pmod("slot", F.lit(size)))
    return numbered.join(side, f"{id_column}_index").drop(f"{id_column}_index")


def _with_zero_labels(pairs: DataFrame, item: str, user: str) -> DataFrame:
    return pairs.select(item, user, *[F.lit(0).cast("tinyint").alias(e) for e in LABELS])


def zipped_fill(train: DataFrame, test: DataFrame, item: str, user: str) -> DataFrame:
    """Zero-label rows in which every missing item and every missing user occurs.

    Both sides are numbered in id order and paired by position; the shorter side starts over. A
    side without missing ids lends the smallest id that train has.
    """
    spark = train.sparkSession
    items, n_items = _numbered(missing_ids(train, test, item), item)
    users, n_users = _numbered(missing_ids(train, test, user), user)
    slots = spark.range(max(n_items, n_users)).withColumnRenamed("id", "slot")
    for id_column, index, size in ((item, items, n_items), (user, users, n_users)):
        if size:
            slots = _attach(slots, index, size, id_column)
        else:
            smallest = train.agg(F.min(id_column)).scalar()
            slots = slots.withColumn(id_column, smallest)
    return _with_zero_labels(slots, item, user)


def partnered_fill(train: DataFrame, test: DataFrame, item: str, user: str) -> DataFrame:
    """Zero-label rows that pair each missing id with a known id of the other side.

    Known partners are taken in turn, so that none of them becomes frequent. The number of rows
    is the number of missing ids, not the product of both sides.
    """
    parts = []
    for id_column, other in ((item, user), (user, item)):
        index, _ = _numbered(missing_ids(train, test, id_column), id_column)
        partners, n_partners = _numbered(train.select(other), other)
        slots = index.select(id_column, F.col(f"{id_column}_index").alias("slot"))
        if n_partners:
            parts.append(_attach(slots, partners, n_partners, other).select(item, user))
    if not parts:
        return _with_zero_labels(train.select(item, user).limit(0), item, user)
    return _with_zero_labels(parts[0].unionByName(parts[1]), item, user)


def full_train(train: DataFrame, fill: DataFrame) -> DataFrame:
    """Train rows and fill rows together."""
    return train.select(*fill.columns).unionByName(fill)
