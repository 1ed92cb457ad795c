"""Hard-negative mining with matrix products in a residue number system.

Integer vectors are reduced modulo a few small primes. Residues are multiplied in float32, whose sums
stay below 2^24 and are exact; the Chinese remainder theorem puts the products of all primes together
to the exact signed score. The best rows of an anchor's own label are its positives; the best rows of
other labels inside a window of scores below a positive are its negatives.

Anchors and candidates are dealt out by id into cells of bounded size, so that no label, anchor or
task meets an unbounded group; each cell keeps only the best few rows of every anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.operators.ordering import top_k
from impressa.session import materialize

# A cell scores at most about this many anchors against this many candidates.
ANCHOR_BLOCK = 512
CANDIDATE_BLOCK = 4096
# Primes below 2^8, largest first. Residues lie within half a prime of zero.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
# float32 holds every integer up to 2^24.
_EXACT = 1 << 24
_NOTHING = np.iinfo(np.int64).min


# ---------------------------------------------------------------- residue number system


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all integers of absolute value up to ``bound`` apart."""
    product, chosen = 1, []
    for prime in PRIMES:
        if product > 2 * bound:
            break
        chosen.append(prime)
        product *= prime
    if product <= 2 * bound:
        raise ValueError("scores must be below 2^61")
    return tuple(chosen)


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """``matrix`` modulo ``prime`` as float32, centred on zero."""
    half = prime // 2
    return ((matrix + half) % prime - half).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T modulo ``prime``, by slices of columns whose sums are exact in float32."""
    half = prime // 2
    columns = _EXACT // (half * half)
    left, right = residues(a, prime), residues(b, prime)
    total = np.zeros((len(a), len(b)), np.int64)
    for start in range(0, a.shape[1], columns):
        total += (left[:, start : start + columns] @ right[:, start : start + columns].T).astype(np.int64)
    return total % prime


def exact_products(a: np.ndarray, b: np.ndarray, primes: tuple[int, ...]) -> np.ndarray:
    """a @ b.T of integer matrices, exact if the primes tell the scores apart.

    Mixed-radix digits are found one prime after the other. The product of all primes is below 2^63,
    so their weighted sum fits into a long; its upper half stands for the negative scores.
    """
    digits: list[np.ndarray] = []
    for i, prime in enumerate(primes):
        digit = _product(a, b, prime)
        for earlier, known in zip(primes[:i], digits, strict=True):
            digit = (digit - known) * pow(earlier, -1, prime) % prime
        digits.append(digit)
    score = np.zeros((len(a), len(b)), np.int64)
    whole = 1
    for prime, digit in zip(primes, digits, strict=True):
        score += digit * np.int64(whole)
        whole *= prime
    return np.where(score > whole // 2, score - whole, score)


# ---------------------------------------------------------------- cells


def integer_rows(df: DataFrame, id_column: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, vector array<bigint>) with floor(scale * x) of each component taken as double.

    Rows with a null id or label, a null vector, or null or non-finite components are left out.
    """
    raw = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(raw, lambda x: F.floor(x * scale))
    usable = F.col(id_column).isNotNull() & F.col(vector).isNotNull() & label.isNotNull() & finite
    return df.filter(usable).select(
        F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole.alias("vector")
    )


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _best(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the best, second best ... kth entry of each row, the left one of ties.

    ``scores`` is used up.
    """
    for _ in range(min(k, scores.shape[1])):
        column = scores.argmax(axis=1)
        row = np.flatnonzero(scores[np.arange(len(scores)), column] != _NOTHING)
        if not len(row):
            return
        yield row, column[row]
        scores[row, column[row]] = _NOTHING


def _cell(primes: tuple[int, ...], choose: Callable, names: tuple[str, ...]):
    """A cell's function: exact scores, then ``choose`` among the candidates in order of their ids."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by("id")
            scores = exact_products(_matrix(anchors), _matrix(candidates), primes)
            found = list(choose(anchors, candidates, scores))
        columns = zip(*found, strict=True) if found else [[np.zeros(0, np.int64)]] * len(names)
        return pa.table({n: np.concatenate(list(c)) for n, c in zip(names, columns, strict=True)})

    return run


def _cells(anchors: DataFrame, candidates: DataFrame, blocks: tuple[int, int], function, schema) -> DataFrame:
    """Apply ``function`` to every (anchor block, candidate block) of equal vector length."""
    rows, columns = blocks
    place = lambda n: F.pmod(F.xxhash64("id", "label"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.size("vector").alias("length")
    left = anchors.select("*", length, place(rows).alias("i"), every(columns).alias("j"))
    right = candidates.select("*", length, every(rows).alias("i"), place(columns).alias("j"))
    keys = ["length", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(function, schema)


def _positives(k: int):
    def choose(anchors: pa.Table, candidates: pa.Table, scores: np.ndarray) -> Iterator[tuple]:
        ids, others = anchors["id"].to_numpy(), candidates["id"].to_numpy()
        fits = anchors["label"].to_numpy()[:, None] == candidates["label"].to_numpy()[None, :]
        fits &= ids[:, None] != others[None, :]
        keys = anchors["row"].to_numpy()
        for row, column in _best(np.where(fits, scores, _NOTHING), k):
            yield keys[row], others[column], scores[row, column]

    return choose


def _negatives(k: int, low: int, high: int):
    def choose(anchors: pa.Table, candidates: pa.Table, scores: np.ndarray) -> Iterator[tuple]:
        others = candidates["id"].to_numpy()
        keys, positives = anchors["row"].to_numpy(), anchors["positives"].to_pylist()
        differs = anchors["label"].to_numpy()[:, None] != candidates["label"].to_numpy()[None, :]
        for place in range(max(map(len, positives), default=0)):
            held = np.array([i for i, p in enumerate(positives) if len(p) > place])
            score = [positives[i][place]["score"] for i in held]
            # low * p <= 100 * n <= high * p as bounds of n, in integers of any size.
            least = np.array([-(-low * p // 100) for p in score], np.int64)
            most = np.array([high * p // 100 for p in score], np.int64)
            inside = (scores[held] >= least[:, None]) & (scores[held] <= most[:, None]) & differs[held]
            for row, column in _best(np.where(inside, scores[held], _NOTHING), k):
                at = held[row]
                yield keys[at], np.full(len(at), place, np.int64), others[column], scores[at, column]

    return choose


# ---------------------------------------------------------------- operator


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``vectors`` has (id bigint, label bigint, vector array<bigint>). An anchor's positives are the
    ``positives`` best other rows of its label; of each, the ``negatives`` best rows of other labels
    with ``low`` to ``high`` percent of the positive's score are returned, all if fewer. Scores are
    inner products and must be below 2^61; ties go to the smaller id.

    Only vectors of equal length are compared. Rows with the anchor's id are no candidates of it.
    Repeated rows each count: a repeated candidate can take several ranks, and a repeated anchor
    returns its rows as often. Anchors without positives, or positives without rows in the window,
    return none; an empty table gives no rows. Other columns are not looked at.
    """
    rows = materialize(
        vectors.select("id", "label", "vector").withColumn("row", F.monotonically_increasing_id())
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") ** 2)
    facts = rows.agg(
        F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(square).alias("square")
    ).first()
    # No score is beyond the product of two norms; a little more makes up for rounding.
    primes = primes_for(int((facts["square"] or 0.0) * 1.000001) + 1)
    blocks = (max(1, -(-facts["anchors"] // ANCHOR_BLOCK)), max(1, -(-facts["rows"] // CANDIDATE_BLOCK)))
    anchors, candidates = rows.filter(is_anchor), rows.drop("row")
    near = _cells(
        anchors, candidates, blocks, _cell(primes, _positives(positives), ("row", "id", "score")),
        "row bigint, id bigint, score bigint",
    )
    best = top_k(near, "row", [F.desc("score"), F.asc("id")], positives)
    # A few positives per anchor, in order.
    lists = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    armed = materialize(anchors.join(lists, "row"))
    found = _cells(
        armed, candidates, blocks,
        _cell(primes, _negatives(negatives, low, high), ("row", "place", "id", "score")),
        "row bigint, place bigint, id bigint, score bigint",
    ).withColumn("pair", F.struct("row", "place"))
    kept = top_k(found, "pair", [F.desc("score"), F.asc("id")], negatives)
    chosen = F.element_at("positives", (F.col("place") + 1).cast("int"))
    names = armed.select("row", F.col("id").alias("anchor_id"), "positives")
    return kept.join(names, "row").select(
        "anchor_id",
        chosen["id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        chosen["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
