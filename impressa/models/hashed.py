"""Factorisation machine on hashed ids: scores without an id index, of unseen ids as well.

The model is logistic, of degree two, fitted by AdamW steps over all rows, as by the library's
``FMClassifier``, whose first weights it takes. A row has two buckets at most, so gradients are
taken over arrays of bucket numbers; equal rows are counted once, and each step serves all labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import FeatureHasher
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.session import materialize
from impressa.sources.schemas import KEYS

# Buckets of users and items together. The model has BUCKETS * (factors + 1) numbers, whatever the ids.
BUCKETS = 1 << 16
SEED = 42
REGULARISATION, TOLERANCE = 1e-4, 1e-6
# Decay of the two moments of a gradient, and what is added to the root of the second.
_DECAY, _SQUARE_DECAY, _EPSILON = 0.9, 0.999, 1e-8
# Rows of a stored block at most, and of a stretch whose gradient is taken at once.
BLOCK_ROWS, _STRETCH = 1 << 18, 1 << 16
_SLOTS = ["first", "second", "first_value", "second_value"]


def hashed_pairs(rows: DataFrame, labels: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(user, item, labels, features): one bucket for the user and one for the item; a null id has none."""
    hasher = FeatureHasher(inputCols=KEYS, outputCol="features", numFeatures=buckets)
    return hasher.transform(rows.select(*KEYS, *labels))


@dataclass(frozen=True)
class Machine:
    """Intercept, a weight per bucket, and factors per bucket."""

    intercept: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, first, second, first_value, second_value) -> np.ndarray:
        """Log odds of rows; the second value is 0 where both ids share a bucket or one is missing."""
        both = np.einsum("ij,ij->i", self.factors[first], self.factors[second])
        weight = self.linear[first] * first_value + self.linear[second] * second_value
        return self.intercept + weight + both * first_value * second_value


def _slots() -> list[Column]:
    """Two buckets and their values out of a sparse vector; an absent one is bucket 0 with value 0."""
    vector = F.unwrap_udt("features")
    cells = [F.get(vector[part], F.lit(i)) for part in ("indices", "values") for i in (0, 1)]
    return [F.coalesce(c, F.lit(0)).cast(t).alias(n) for c, t, n in zip(cells, ("int", "int", "double", "double"), _SLOTS, strict=True)]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks: a row per block, a list per column."""

    def block(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting).combine_chunks()
        ends = pa.array([0, table.num_rows], pa.int32())
        columns = [table[c].combine_chunks() if table[c].num_chunks != 1 else table[c].chunk(0) for c in table.column_names]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, c) for c in columns], table.column_names)

    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block(waiting)
            waiting, rows = [], 0
    if rows:
        yield block(waiting)


def _blocks(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Distinct rows with how often they occur and how often with each label, written in blocks."""
    sums = [F.sum(F.col(label).cast("double")).alias(f"label_{i}") for i, label in enumerate(labels)]
    counted = pairs.select(*_slots(), *labels).groupBy(*_SLOTS).agg(F.count("*").cast("double").alias("rows"), *sums)
    packed = counted.mapInArrow(_packed, ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in counted.schema))
    return materialize(packed)


def _gradient(machine: Machine, slots: list[np.ndarray], rows: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Sum of the gradients of the loss, laid out as (factors | linear) per bucket, with the intercept's last."""
    first, second, x, z = slots
    buckets, size = machine.factors.shape
    raw = machine.raw(*slots)
    error = rows / (1 + np.exp(-raw)) - positives
    out = np.empty((size + 1) * buckets + 1)
    cross = (error * x * z)[:, None]
    towards_first, towards_second = cross * machine.factors[second], cross * machine.factors[first]
    for f in range(size):
        out[f * buckets : (f + 1) * buckets] = np.bincount(first, towards_first[:, f], buckets)
        out[f * buckets : (f + 1) * buckets] += np.bincount(second, towards_second[:, f], buckets)
    out[size * buckets : -1] = np.bincount(first, error * x, buckets) + np.bincount(second, error * z, buckets)
    out[-1] = error.sum()
    return out


def _machine(weights: np.ndarray, size: int) -> Machine:
    buckets = (len(weights) - 1) // (size + 1)
    factors = np.ascontiguousarray(weights[: size * buckets].reshape(size, buckets).T)
    return Machine(float(weights[-1]), weights[size * buckets : -1], factors)


def _partial_gradients(weights, size: int, active: list[int], blocks: Iterator) -> Iterator[np.ndarray]:
    """One array per task, a row per label, whatever the number of its blocks."""
    machines = [_machine(weights.value[i], size) for i in active]
    total = None
    for block in blocks:
        columns = [np.asarray(c) for c in block]
        for at in range(0, len(columns[0]), _STRETCH):
            first, second, x, z, rows, *positives = [c[at : at + _STRETCH] for c in columns]
            slots = [first.astype(np.int64), second.astype(np.int64), x, z]
            found = np.stack([_gradient(m, slots, rows, positives[i]) for i, m in zip(active, machines, strict=True)])
            total = found if total is None else np.add(total, found, out=total)
    if total is not None:
        yield total


def _first_weights(pairs: DataFrame, label: str, factors: int, seed: int) -> np.ndarray:
    """The weights that the library's machine begins with."""
    start = FMClassifier(
        featuresCol="features", labelCol=label, factorSize=factors, maxIter=0, initStd=0.1, seed=seed
    ).fit(pairs.limit(1))
    drawn = start.factors.toArray()
    return np.concatenate([drawn.T.ravel(), start.linear.toArray(), [start.intercept]])


def fit_all(
    pairs: DataFrame,
    labels: Sequence[str],
    factors: int = 8,
    iterations: int = 60,
    step: float = 0.1,
    seed: int = SEED,
) -> dict[str, Machine]:
    """Logistic factorisation machines of several labels: each step is one pass over the rows for all of them.

    A task adds up its rows to one gradient, as large as the model; there are as many tasks as cores at
    most, so that what they send does not grow with the rows. A label is done when its weights hardly move any more.
    """
    spark = pairs.sparkSession
    context = spark.sparkContext
    weights = np.stack([_first_weights(pairs, labels[0], factors, seed)] * len(labels))
    blocks = _blocks(pairs, labels)
    added = F.expr("aggregate(rows, 0D, (s, x) -> s + x)")
    n, distinct = blocks.agg(F.sum(added), F.sum(F.size("rows"))).first()
    stored = blocks.rdd.coalesce(min(context.defaultParallelism, -(-distinct // BLOCK_ROWS)))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    active = list(range(len(labels)))
    for turn in range(1, iterations + 1):
        sent = context.broadcast(weights)
        gradient = stored.mapPartitions(partial(_partial_gradients, sent, factors, active)).treeReduce(np.add) / n
        sent.destroy()
        mean[active] = _DECAY * mean[active] + (1 - _DECAY) * gradient
        square[active] = _SQUARE_DECAY * square[active] + (1 - _SQUARE_DECAY) * gradient * gradient
        moved = (mean[active] / (1 - _DECAY**turn)) / (np.sqrt(square[active] / (1 - _SQUARE_DECAY**turn)) + _EPSILON)
        before = weights[active]
        weights = weights.copy()
        weights[active] = before - step * moved - REGULARISATION * before
        near = np.linalg.norm(weights[active] - before, axis=1) < TOLERANCE * np.maximum(
            np.linalg.norm(weights[active], axis=1), 1
        )
        if turn > 1:
            active = [i for i, done in zip(active, near, strict=True) if not done]
        if not active:
            break
    return {label: _machine(weights[i], factors) for i, label in enumerate(labels)}


def fit(
    pairs: DataFrame, label: str, factors: int = 8, iterations: int = 60, step: float = 0.1, seed: int = SEED
) -> Machine:
    """The machine of one label; see :func:`fit_all`."""
    return fit_all(pairs, [label], factors, iterations, step, seed)[label]


def _scorer(model: Machine) -> Callable:
    @F.pandas_udf("double")
    def score(first: pd.Series, second: pd.Series, first_value: pd.Series, second_value: pd.Series) -> pd.Series:
        raw = model.raw(*[c.to_numpy() for c in (first, second, first_value, second_value)])
        return pd.Series(1 / (1 + np.exp(-raw)))

    return score


def scores(model: Machine, pairs: DataFrame) -> DataFrame:
    """Pairs with the probability of the engagement as ``prediction``."""
    kept = [c for c in pairs.columns if c != "features"]
    return pairs.select(*kept, _scorer(model)(*_slots()).alias("prediction"))
