"""Best items by factors, without scoring all pairs where norms rule pairs out.

No score is beyond the product of two norms. Items are numbered by falling norm and met in that order,
in rounds that grow; after a round, a query is done if its kth score is above what its norm and the
largest norm still to come can give. Queries and items meet in cells of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators.ordering import number_rows, top_k
from impressa.session import materialize

# Queries and items of a cell at most, about; the first round is one block of items. Items are sent once
# per block of queries, so blocks of queries are large, but for few queries, so that all tasks have some.
QUERY_BLOCK, ITEM_BLOCK = 16384, 8192
_LEAST_QUERIES = 1024
# Queries of a cell that are scored at once, and items of which only the best is looked at first.
_STRETCH, _GROUP = 512, 16
# What rounding can add to a bound.
_SLACK = 1 + 1e-6


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1).astype(np.float64)


def _lower_bound(scores: np.ndarray, k: int) -> np.ndarray:
    """A number per row that its kth best score reaches: the kth best of the best scores of groups of items."""
    n, m = scores.shape
    groups = m // _GROUP
    if groups >= k:
        scores, m = scores[:, : groups * _GROUP].reshape(n, _GROUP, groups).max(axis=1), groups
    kept = min(k, m)
    return np.partition(scores, m - kept, axis=1)[:, m - kept]


def _cell(k: int):
    """The k best items of a cell for each of its queries that they can matter to, with all ties and few others."""

    def best(queries: pa.Table, items: pa.Table) -> pa.Table:
        if queries.num_rows and items.num_rows:
            reach = queries["norm"].to_numpy() * items["norm"].to_numpy().max() * _SLACK
            queries = queries.filter(pa.array(reach >= queries["kth"].to_numpy()))
        if not queries.num_rows or not items.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"query": none, "item": none, "score": pa.array([], pa.float64())})
        wanted, offered, known = _matrix(queries), _matrix(items).T, queries["kth"].to_numpy()
        rows, columns, found = [], [], []
        for at in range(0, len(wanted), _STRETCH):
            scores = wanted[at : at + _STRETCH] @ offered
            least = np.maximum(_lower_bound(scores, k), known[at : at + _STRETCH])
            row, column = np.nonzero(scores >= least[:, None])
            rows.append(row + at)
            columns.append(column)
            found.append(scores[row, column])
        return pa.table(
            {
                "query": queries["id"].to_numpy()[np.concatenate(rows)],
                "item": items["id"].to_numpy()[np.concatenate(columns)],
                "score": np.concatenate(found),
            }
        )

    return best


def _factors(side: DataFrame) -> DataFrame:
    values = F.col("features").cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
    return side.select(F.col("id").cast("bigint").alias("id"), values.alias("features"), norm.alias("norm"))


def best_by_factors(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(query, item, score, rank): the k best items of each query by inner product, ties by smaller item.

    Both tables are (id, features) with unique ids and arrays of one length. All items are returned
    where there are fewer than k; without queries or items there are no rows.
    """
    items = materialize(number_rows(_factors(items), [F.desc("norm"), "id"], "place"))
    waiting = materialize(_factors(queries))
    n_items, n_queries = items.count(), waiting.count()
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = None
    start, end = 0, ITEM_BLOCK
    while n_items and n_queries:
        chosen = items.filter((F.col("place") >= start) & (F.col("place") < end))
        block = F.floor((F.col("place") - start) / ITEM_BLOCK).cast("int")
        # The largest norm of each block, falling: the blocks that matter to a query are the first ones.
        firsts = chosen.filter((F.col("place") - start) % ITEM_BLOCK == 0).orderBy("place").collect()
        largest = F.array(*[F.lit(r["norm"]) for r in firsts])
        groups = max(-(-n_queries // QUERY_BLOCK), min(tasks, -(-n_queries // _LEAST_QUERIES)))
        kth = F.col("kth") if "kth" in waiting.columns else F.lit(float("-inf"))
        reached = F.size(F.filter(largest, lambda top: F.col("norm") * top * _SLACK >= F.col("kth")))
        left = waiting.withColumn("kth", kth).withColumn("reached", reached).filter("reached > 0").select(
            "id", "features", "norm", "kth",
            F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("i"),
            F.explode(F.sequence(F.lit(0), F.col("reached") - 1)).alias("j"),
        )
        right = chosen.select(
            "id", "features", "norm", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("i"), block.alias("j")
        )
        scored = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
            _cell(k), "query bigint, item bigint, score double"
        )
        both = scored if found is None else found.select("query", "item", "score").unionByName(scored)
        found = materialize(top_k(both, "query", [F.desc("score"), F.asc("item")], k))
        if end >= n_items:
            return found
        ahead = items.filter(F.col("place") == end).first()["norm"]
        last = found.filter(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").alias("kth"))
        undecided = F.col("kth").isNull() | (F.col("norm") * ahead * _SLACK >= F.col("kth"))
        waiting = materialize(
            waiting.select("id", "features", "norm").join(last, "id", "left").filter(undecided)
            .withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
        )
        n_queries = waiting.count()
        start, end = end, end + 2 * (end - start)
    if found is not None:
        return found
    return queries.sparkSession.createDataFrame([], "query bigint, item bigint, score double, rank int")
