"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate in blocks of bounded size. Score histograms, summed
over all blocks, narrow down the interval that holds each query's kth score, until it is one score
wide. A last pass keeps the scores above it and as many ties as are needed, by smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from impressa.operators.ordering import top_k
from impressa.session import materialize

# A cell scores at most about this many queries against this many candidates at once.
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
# Each pass cuts the interval of a query into this many bits of histogram bins.
BITS_A_PASS = 9


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, vector array<bigint>) with floor(scale * x) of each component taken as double.

    Rows with a null id, a null vector, or null or non-finite components are left out.
    """
    raw = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(
        raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(raw, lambda x: F.floor(x * scale))
    return df.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id_column).alias("id"), scaled.alias("vector")
    )


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1) if table.num_rows else flat.reshape(0, 0)


def _scores(queries: pa.Table, candidates: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Inner products, and which of them are not of a row with itself."""
    q, c = _matrix(queries), _matrix(candidates)
    top = max(1, q.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    if top < 2.0**53:  # every partial sum is exact in double
        scores = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        scores = q @ c.T
    other = queries["id"].to_numpy()[:, None] != candidates["id"].to_numpy()[None, :]
    return scores, other


def _count(k: int, shift: int):
    """Histogram of a cell: (row, bin, scores), from the top bin down to the cell's own kth score.

    Lower bins cannot hold the query's kth score, as this cell has k scores above them.
    """

    def count(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "bin": pa.array([], pa.int64()),
                             "scores": pa.array([], pa.int64())})
        scores, other = _scores(queries, candidates)
        low, width = queries["low"].to_numpy(), queries["width"].to_numpy()
        offset = scores - low[:, None]
        bins = offset >> shift
        inside = other & (offset >= 0) & (offset < width[:, None])
        size = 1 << BITS_A_PASS
        row = np.broadcast_to(np.arange(len(low))[:, None], bins.shape)
        counts = np.bincount((row[inside] * size + bins[inside]), minlength=len(low) * size)
        counts = counts.reshape(len(low), size)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        at, which = np.nonzero((counts > 0) & (above < k))
        return pa.table({"row": queries["row"].to_numpy()[at], "bin": which.astype(np.int64),
                         "scores": counts[at, which].astype(np.int64)})

    return count


def _take(k: int):
    """Scores above each query's kth score, and the k smallest ids of a cell that equal it."""

    def take(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"row": none, "query_id": none, "id": none, "score": none})
        candidates = candidates.take(pc.sort_indices(candidates["id"]))
        scores, other = _scores(queries, candidates)
        low = queries["low"].to_numpy()[:, None]
        tied = other & (scores == low)
        keep = (other & (scores > low)) | (tied & (tied.cumsum(axis=1) <= k))
        at, which = np.nonzero(keep)
        return pa.table({"row": queries["row"].to_numpy()[at], "query_id": queries["id"].to_numpy()[at],
                         "id": candidates["id"].to_numpy()[which], "score": scores[at, which]})

    return take


def _cells(queries: DataFrame, candidates: DataFrame, blocks: tuple[int, int], function, schema):
    """Apply ``function`` to every (query block, candidate block) of equal vector length."""
    by_query, by_candidate = blocks
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select(
        *[F.col(c).alias(c) for c in queries.columns],
        F.size("vector").alias("length"), place(by_query).alias("i"), every(by_candidate).alias("j"),
    )
    right = candidates.select(
        *[F.col(c).alias(c) for c in candidates.columns],
        F.size("vector").alias("length"), every(by_query).alias("i"), place(by_candidate).alias("j"),
    )
    keys = ["length", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(function, schema)


def top_k_search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, id, score): the k best inner products of each query with all other rows.

    ``vectors`` has (id bigint, vector array<bigint>); a row is no candidate of a query with its own id.
    Repeated rows each count: a repeated candidate takes several ranks, and each row of a repeated query
    has its own result, so these are returned as often. Only vectors of equal length are compared; scores must fit into a long. Ties
    go to the smaller id; queries with fewer than k candidates return all of them. Without queries
    or candidates there are no rows.
    """
    vectors = materialize(vectors.select("id", "vector").withColumn("row", F.monotonically_increasing_id()))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") ** 2))
    facts = vectors.agg(
        F.count("*").alias("rows"), F.count_if(is_query).alias("queries"), F.max(norm).alias("norm")
    ).first()
    blocks = (
        max(1, -(-facts["queries"] // QUERY_BLOCK)), max(1, -(-facts["rows"] // CANDIDATE_BLOCK))
    )
    # No score is beyond the product of two norms.
    bits = max(1, int(np.ceil(np.log2((facts["norm"] or 0.0) ** 2 + 2))) + 1)
    queries = vectors.filter(is_query)
    state = queries.select(
        "row",
        F.lit(-(1 << bits - 1)).cast("bigint").alias("low"),
        F.lit(1 << bits).cast("bigint").alias("width"),
        F.lit(0).cast("bigint").alias("above"),
    )
    while bits > 0:
        bits = max(0, bits - BITS_A_PASS)
        counts = _cells(
            queries.join(state, "row"), vectors, blocks, _count(k, bits),
            "row bigint, bin bigint, scores bigint",
        )
        summed = counts.groupBy("row", "bin").agg(F.sum("scores").alias("scores"))
        down = Window.partitionBy("row").orderBy(F.desc("bin"))
        found = (
            summed.withColumn("reached", F.sum("scores").over(down))
            .join(state, "row")
            .filter(F.col("above") + F.col("reached") >= k)
            .groupBy("row")
            .agg(F.max(F.struct("bin", (F.col("reached") - F.col("scores")).alias("more"))).alias("at"))
        )
        # A query with fewer than k candidates keeps its lowest bound, above which all scores are.
        state = materialize(
            state.join(found, "row", "left").select(
                "row",
                F.coalesce(F.col("low") + F.shiftleft("at.bin", bits), F.col("low")).alias("low"),
                F.when(F.col("at").isNotNull(), F.lit(1 << bits)).otherwise(F.lit(0)).cast("bigint").alias("width"),
                (F.col("above") + F.coalesce(F.col("at.more"), F.lit(0))).alias("above"),
            )
        )
    kept = _cells(
        queries.join(state, "row"), vectors, blocks, _take(k),
        "row bigint, query_id bigint, id bigint, score bigint",
    )
    return top_k(kept, "row", [F.desc("score"), F.asc("id")], k).select(
        "query_id", "rank", "id", "score"
    )
