"""Relevance feedback: a term profile per user from engaged and ignored items, and its scores.

profile = mean of the engaged item vectors - mean of the ignored ones, per label; the score of an
item is its cosine with the profile, mapped to 0..1. All four labels share every pass.

A profile is a sum of item vectors, each with a weight of its pair. Pairs meet the vectors they need in
cells of bounded size, where vectors unfold into terms; no table of terms by pair is shuffled or written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from impressa.functions.similarity import unit_score
from impressa.operators.joins import hot_keys, spread_join
from impressa.session import materialize
from impressa.sources.schemas import ITEM, KEYS, LABELS, USER

# A user with more pairs than this is worked on in several pieces, each with some of the terms.
HOT_USER_PAIRS = 50_000
# Terms that the pairs of a cell unfold into, about; a user with more is worked on in pieces, too.
CELL_TERMS = 1 << 20
_CELL = ["_block", "_pieces", "_piece"]
_CELLS_PER_TASK = 8


def pair_counts(interactions: DataFrame) -> DataFrame:
    """(user, item, n, n_<label>...): impressions and engagements of each pair."""
    return interactions.groupBy(USER, ITEM).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(label).cast("bigint")).alias(f"n_{label}") for label in LABELS],
    )


def _pair_vectors(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs with the item's vector; it travels as an array and is unfolded where it is used."""
    return spread_join(pairs, vectors, ITEM, USER)


def _cells(weighted: DataFrame, vectors: DataFrame, tested: DataFrame | None = None) -> tuple:
    """(pairs, vectors) by cell, laid out alike.

    A cell has whole users, of which each vector is there once; or some of the terms, by number, of a
    user that is too large for one cell, with all its pairs. Users are dealt to as many blocks as the
    terms need; the number of tasks follows from it, as rows fan out in the cells.
    """
    names = [c for c in weighted.columns if c not in KEYS]
    pairs = weighted.withColumn("_tested", F.lit(False))
    if tested is not None:
        asked = tested.select(*KEYS, *[F.lit(None).cast("double").alias(c) for c in names], F.lit(True).alias("_tested"))
        pairs = pairs.unionByName(asked)
    sizes = vectors.select(ITEM, F.size("terms").alias("_terms"))
    loads = pairs.filter(F.col(USER).isNotNull()).join(sizes, ITEM).groupBy(USER)
    loads = materialize(loads.agg(F.sum("_terms").alias("_load"), F.count("*").alias("_pairs")))
    pieces = F.greatest(F.ceil(F.col("_load") / CELL_TERMS), F.ceil(F.col("_pairs") / HOT_USER_PAIRS), F.lit(1))
    total = loads.agg(F.coalesce(F.sum("_load"), F.lit(0)).alias("terms"), F.sum(pieces).alias("pieces")).first()
    blocks = max(1, -(-total["terms"] // CELL_TERMS))
    spread = F.xxhash64(USER)
    block = F.when(pieces > 1, spread).otherwise(F.pmod(spread, F.lit(blocks)))
    placed = pairs.join(loads.select(USER, block.alias("_block"), pieces.cast("int").alias("_pieces")), USER)
    placed = materialize(placed.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))))
    part = F.when(F.col("_pieces") == 1, F.col("terms")).otherwise(
        F.filter("terms", lambda t: F.pmod(t["term_index"], F.col("_pieces")) == F.col("_piece"))
    )
    needed = placed.select(*_CELL, ITEM).distinct().join(vectors, ITEM).withColumn("terms", part)
    # Columns of their own, as both sides of a cell come from one table.
    needed = needed.select(*_CELL, ITEM, "terms.term_index", "terms.weight").toDF(*_CELL, ITEM, "_index", "_weight")
    least = int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-(blocks + (total["pieces"] or 0) - loads.count()) // _CELLS_PER_TASK))
    return tuple(side.repartition(tasks, *_CELL).groupBy(*_CELL) for side in (placed, needed))


class _Unfolded:
    """The terms of the pairs of a cell: ``row`` of the pair, ``key`` of user and term, ``weight``."""

    def __init__(self, pairs: pa.Table, vectors: pa.Table):
        at = pc.index_in(pairs[ITEM], value_set=vectors[ITEM].combine_chunks())
        self.pairs = pairs.filter(at.is_valid())
        at = at.drop_null().to_numpy().astype(np.int64)
        lists, weights = vectors["_index"].combine_chunks(), vectors["_weight"].combine_chunks()
        starts, ends = lists.offsets.to_numpy()[:-1].astype(np.int64), lists.offsets.to_numpy()[1:]
        sizes = ends[at] - starts[at]
        self.row = np.repeat(np.arange(len(at)), sizes)
        place = np.arange(len(self.row)) + np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes)
        terms = lists.values.to_numpy()
        self.weight = weights.values.to_numpy()[weights.offsets.to_numpy()[0] - starts[0] + place]
        users = self.pairs[USER].combine_chunks().dictionary_encode()
        self.users, self.user = users.dictionary, users.indices.to_numpy().astype(np.int64)
        self.spread = int(terms.max(initial=0)) + 1
        self.key = self.user[self.row] * self.spread + terms[place]
        self.tested = self.pairs["_tested"].to_numpy()

    def column(self, name: str) -> np.ndarray:
        return self.pairs[name].to_numpy()

    def sums(self, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(keys, sum of each weight column times the term's weight) over the pairs that are not tested."""
        chosen = np.flatnonzero(~self.tested[self.row])
        order = chosen[np.argsort(self.key[chosen], kind="stable")]
        keys, row, weight = self.key[order], self.row[order], self.weight[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        if not len(first):
            return keys, [np.zeros(0) for _ in names]
        return keys[first], [np.add.reduceat(self.column(c)[row] * weight, first) for c in names]


def _summed_terms(names: list[str], arrow: pa.Schema):
    def add(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        if not pairs.num_rows or not vectors.num_rows:
            return arrow.empty_table()
        cell = _Unfolded(pairs, vectors)
        keys, sums = cell.sums(names)
        columns = [cell.users.take(pa.array(keys // cell.spread)), pa.array(keys % cell.spread), *map(pa.array, sums)]
        return pa.table(columns, names=arrow.names).cast(arrow)

    return add


def _scored_pairs(names: list[str], arrow: pa.Schema):
    def score(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        if not pairs.num_rows or not vectors.num_rows:
            return arrow.empty_table()
        cell = _Unfolded(pairs, vectors)
        keys, sums = cell.sums(names)
        owner, n = keys // cell.spread, len(cell.users)
        asked = np.flatnonzero(cell.tested)
        chosen = np.flatnonzero(cell.tested[cell.row])
        row, weight = cell.row[chosen], cell.weight[chosen]
        at = np.searchsorted(keys, cell.key[chosen])
        met = np.flatnonzero(np.r_[keys, -1][at] == cell.key[chosen]) if len(keys) else np.zeros(0, np.int64)
        per_row = lambda rows, values: np.bincount(rows, values, cell.pairs.num_rows)[asked]
        dots = [per_row(row[met], s[at[met]] * weight[met]) for s in sums]
        squares = [np.bincount(owner, s * s, n)[cell.user[asked]] for s in sums]
        known = np.bincount(owner, minlength=n)[cell.user[asked]]
        terms = np.bincount(row, minlength=cell.pairs.num_rows)[asked]
        rows = cell.pairs.take(pa.array(asked))
        columns = [rows[USER], rows[ITEM], known, terms, per_row(row, weight * weight), *dots, *squares]
        return pa.table(columns, names=arrow.names).cast(arrow)

    return score


def _in_cells(cells: tuple, function, names: list[str], schema: T.StructType) -> DataFrame:
    pairs, vectors = cells
    return pairs.cogroup(vectors).applyInArrow(function(names, to_arrow_schema(schema)), schema)


def _shares(pairs: DataFrame, label: str) -> tuple[Column, Column]:
    """Weight of a pair's item in the means of the engaged and of the ignored items of its user."""

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    engaged, all_engaged = F.col(f"n_{label}"), F.col(f"_all_{label}")
    return share(engaged, all_engaged), share(F.col("n") - engaged, F.col("_all") - all_engaged)


def _with_sizes(pairs: DataFrame) -> DataFrame:
    """Pairs with the class sizes of their user; pairs without a user vanish."""
    sizes = pairs.groupBy(USER).agg(
        F.sum("n").alias("_all"), *[F.sum(f"n_{label}").alias(f"_all_{label}") for label in LABELS]
    )
    return pairs.join(sizes, USER)


def _unfolded(weighted: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user, term_index, <weight>...): sums of the item vectors of each user by weight."""
    names = [c for c in weighted.columns if c not in KEYS]
    term = vectors.schema["terms"].dataType.elementType["term_index"]
    fields = [weighted.schema[USER], term, *[T.StructField(c, T.DoubleType()) for c in names]]
    return _in_cells(_cells(weighted, vectors), _summed_terms, names, T.StructType(fields))


def class_means(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user, term_index, pos_<label>, neg_<label>...): mean vectors of both classes."""
    shares = [
        share.alias(f"{side}_{e}")
        for e in LABELS
        for side, share in zip(("pos", "neg"), _shares(pairs, e), strict=True)
    ]
    return _unfolded(_with_sizes(pairs).select(*KEYS, *shares), vectors)


def profiles(
    pairs: DataFrame, vectors: DataFrame, positive: float = 1.0, negative: float = 1.0, unfolded: bool = True
) -> DataFrame:
    """(user, term_index, <label>...): positive mean minus negative mean, with class weights.

    Not ``unfolded``, a profile is its items with their weights, (user, item, <label>...): far fewer
    rows, which :func:`profile_scores` takes as well.
    """
    weights = []
    for e in LABELS:
        engaged, ignored = _shares(pairs, e)
        weights.append((positive * engaged - negative * ignored).alias(e))
    weighted = _with_sizes(pairs).select(*KEYS, *weights)
    return _unfolded(weighted, vectors) if unfolded else weighted


def profile_scores(pairs: DataFrame, vectors: DataFrame, user_profiles: DataFrame) -> DataFrame:
    """(user, item, <label>...) for the distinct pairs of users with a profile.

    A pair without a common term scores 0.5; a zero profile or item has no score. Profiles that are not
    unfolded are built in the cells where they are needed.
    """
    if ITEM in user_profiles.columns:
        return _scores_in_cells(pairs, vectors, user_profiles)
    squares = [F.sum(F.col(e) * F.col(e)).alias(f"square_{e}") for e in LABELS]
    lengths = user_profiles.groupBy(USER).agg(*squares)
    lengths = lengths.select(USER, *[F.sqrt(f"square_{e}").alias(f"length_{e}") for e in LABELS])
    wanted = pairs.select(USER, ITEM).distinct()
    hot = hot_keys(wanted, USER)
    terms = _pair_vectors(wanted, vectors).select(*KEYS, F.inline("terms"))
    # A frequent user has the most lookups in its most frequent term: one per item.
    matched = spread_join(
        terms,
        user_profiles,
        USER,
        ITEM,
        how="left",
        hot=hot,
        also_on=("term_index",),
    )
    dots = matched.groupBy(USER, ITEM).agg(
        *[F.sum(F.col("weight") * F.coalesce(F.col(e), F.lit(0.0))).alias(e) for e in LABELS],
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"),
    )
    return _cosines(spread_join(dots, lengths, USER, ITEM, hot=hot))


def _scores_in_cells(pairs: DataFrame, vectors: DataFrame, weighted: DataFrame) -> DataFrame:
    wanted = pairs.select(USER, ITEM).distinct()
    numbers = ["_known", "_terms", "_square", *LABELS, *[f"square_{e}" for e in LABELS]]
    fields = [weighted.schema[c] for c in KEYS] + [T.StructField(c, T.DoubleType()) for c in numbers]
    weighted = weighted.select(*KEYS, *LABELS)
    found = _in_cells(_cells(weighted, vectors, wanted), _scored_pairs, list(LABELS), T.StructType(fields))
    # Pieces of a large user add up.
    dots = found.groupBy(USER, ITEM).agg(*[F.sum(c).alias(c) for c in numbers])
    dots = dots.filter("_known > 0 AND _terms > 0").withColumn("length", F.sqrt("_square"))
    return _cosines(dots.withColumns({f"length_{e}": F.sqrt(f"square_{e}") for e in LABELS}))


def _cosines(scored: DataFrame) -> DataFrame:
    return scored.select(
        USER,
        ITEM,
        *[
            unit_score(
                F.col(e) / F.nullif(F.col("length") * F.col(f"length_{e}"), F.lit(0.0))
            ).alias(e)
            for e in LABELS
        ],
    )
