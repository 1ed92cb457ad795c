"""Connected components of a graph given by its edges, without any list of neighbours in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.operators.joins import hot_keys, spread_join
from impressa.session import materialize

# Keys with fewer rows than this are never split.
_FEW_ROWS = 100


def even_share(spark: SparkSession, rows: int) -> int:
    """Rows of a task, were all dealt evenly: fewer keys than tasks have more."""
    return max(rows // int(spark.conf.get("spark.sql.shuffle.partitions")), _FEW_ROWS)


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def _beside_least(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """Edges beside the least of their ``a``; those of a node with very many are split."""
    hot = hot_keys(edges, "a", min_rows=even_share(edges.sparkSession, rows))
    return spread_join(edges, least, "a", "b", hot=hot)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours.

    Edges go from larger to smaller, so that the larger neighbours are one end of each.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least_neighbour(both).select("a", F.least("a", "least").alias("least"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return (
        _beside_least(larger, least, rows)
        .filter(F.col("b") != F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges go from larger to smaller."""
    least = _least_neighbour(edges)
    moved = (
        _beside_least(edges, least, rows)
        .filter(F.col("b") != F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a bigint, b bigint); loops are left out.

    ``component`` is the least node that can be reached. Large-star and small-star steps alternate
    until every node points at its component's least node; a node's neighbours are only ever
    aggregated and joined, and those of a node with very many are split in the joins.
    Each half round is a written table.
    """
    edges = edges.select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")
    )
    edges = materialize(edges.filter(F.col("a") != F.col("b")).distinct())
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = materialize(_large_star(edges, state[0]))
        edges = materialize(_small_star(edges, state[0]))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
