"""Tables bucketed by their join key, so that joins of them need no exchange.

Predictions and labels are joined on (user, item) again and again: by every evaluation, by the stacker,
for every label. Written once into buckets of the key, rows of one key lie in one bucket of each table,
and a join reads bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.session import delete_at_end, scratch_path

# A bucket holds about this many rows; a table has at least one and at most so many buckets.
BUCKET_ROWS, _MOST_BUCKETS = 1_000_000, 100_000


@dataclass(frozen=True)
class Bucketed:
    """A table in ``buckets`` buckets of ``keys``, sorted by them within each bucket."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def buckets_for(rows: int, least: int = 1) -> int:
    """A power of two, so that tables of different sizes have numbers that divide each other."""
    wanted = max(least, min(_MOST_BUCKETS, -(-rows // BUCKET_ROWS)))
    return 1 << (wanted - 1).bit_length()


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None) -> Bucketed:
    """Write ``df`` into buckets of ``keys``, as an external table under the scratch folder.

    Rows are brought to their buckets by one shuffle first, so that a bucket is one file. The table goes
    with the application. Null keys lie in a bucket like others, and meet nothing in a join. A frequent
    key fills its bucket: reduce it to a row per key before (as :func:`joined` does) or join it by
    :func:`impressa.operators.joins.spread_join`.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    name = name or f"bucketed_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, *[F.col(k) for k in keys])
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).mode(
        "overwrite"
    ).saveAsTable(name)
    delete_at_end(spark, path)
    return Bucketed(spark, name, tuple(keys), buckets)


def write_predictions(tables: dict[str, DataFrame], keys: Sequence[str], buckets: int) -> dict[str, Bucketed]:
    """Each model's (keys, <model>), repeated keys averaged, in the same buckets."""
    return {
        model: write_bucketed(df.groupBy(*keys).agg(F.avg(model).alias(model)), keys, buckets)
        for model, df in tables.items()
    }


def write_labels(labels: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> Bucketed:
    """(keys, label columns), the largest label of repeated keys."""
    return write_bucketed(labels.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns]), keys, buckets)


def joined(predictions: dict[str, Bucketed], labels: Bucketed) -> DataFrame:
    """(keys, <model>..., label columns): keys that every model scored and that have a label.

    One row per key in each table, so nothing multiplies. The plan has no exchange if all tables have the
    same keys and numbers of buckets; others are refused.
    """
    tables = [*predictions.values(), labels]
    if len({(t.keys, t.buckets) for t in tables}) > 1:
        raise ValueError("tables must share keys and number of buckets")
    result = None
    for table in tables:
        rows = table.read().hint("merge")
        result = rows if result is None else result.join(rows, list(table.keys))
    return result
