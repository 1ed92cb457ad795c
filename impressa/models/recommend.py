"""Matrix factorisation on indexed interactions, and a neural model on its factors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.functions.similarity import dot
from impressa.operators import evaluation
from impressa.operators.joins import hot_keys, spread_join
from impressa.session import materialize
from impressa.sources.schemas import ITEM, LABELS, USER

USER_INDEX, ITEM_INDEX = f"{USER}_index", f"{ITEM}_index"

# Iterations and regularisation of every factorisation.
ITERATIONS, REGULARISATION = 5, 0.01
SEED = 42

# Blocks of users and of items. The first factors are drawn by block, so another number gives other
# scores; it is a parameter of the model and never follows the data or the cluster.
BLOCKS = 10


def ratings(train: DataFrame, label: str) -> DataFrame:
    """(user index, item index, rating): how often each pair was engaged, repeats added up.

    Pairs shown without the engagement are rated 0: they add no preference, but their users and
    items have factors as well, which all others are fitted against.
    """
    return train.groupBy(
        F.col(USER_INDEX).cast("int").alias(USER_INDEX),
        F.col(ITEM_INDEX).cast("int").alias(ITEM_INDEX),
    ).agg(F.sum(label).cast("float").alias("rating"))


def _fit(als: ALS, rated: DataFrame, blocks: int) -> ALSModel:
    """Fit on a written table; factors are checkpointed where the session has a checkpoint folder."""
    return als.setNumBlocks(blocks).setCheckpointInterval(2).fit(rated)


def fit_implicit(
    train: DataFrame,
    label: str,
    rank: int = 10,
    alpha: float = 1.0,
    seed: int = SEED,
    blocks: int = BLOCKS,
    rated: DataFrame | None = None,
) -> ALSModel:
    """Implicit-feedback factors of one label.

    An id without any engagement is solved without regularisation, from the factors of the other
    side alone: there must be at least ``rank`` engaged users and items, else the fit fails.
    ``rated`` are its ratings where they have been written before, for several fits.
    """
    als = ALS(
        rank=rank,
        alpha=alpha,
        maxIter=ITERATIONS,
        regParam=REGULARISATION,
        implicitPrefs=True,
        userCol=USER_INDEX,
        itemCol=ITEM_INDEX,
        ratingCol="rating",
        seed=seed,
    )
    return _fit(als, materialize(ratings(train, label)) if rated is None else rated, blocks)


HotKeys = dict[str, DataFrame | None]


def frequent_ids(rows: DataFrame, user: str = USER_INDEX, item: str = ITEM_INDEX) -> HotKeys:
    """Frequent users and items of the rows, to be passed to several scorings of them."""
    return {column: hot_keys(rows, column) for column in (user, item)}


def _with_factors(
    model: ALSModel, rows: DataFrame, user: str, item: str, hot: HotKeys | None
) -> DataFrame:
    """Rows with arrays ``user_factors`` and ``item_factors``, null for unknown ids.

    Frequent users and items are split over many tasks, which ``model.transform`` cannot do. Factors
    travel as the floats they are, and are widened once all have met.
    """
    hot = frequent_ids(rows, user, item) if hot is None else hot
    joined = rows
    for column, spread_by, factors, name in (
        (user, item, model.userFactors, "user_factors"),
        (item, user, model.itemFactors, "item_factors"),
    ):
        side = factors.select(
            F.col("id").cast(rows.schema[column].dataType).alias(column),
            F.col("features").alias(name),
        )
        joined = spread_join(joined, side, column, spread_by, how="left", hot=hot[column])
    return joined.withColumns({c: F.col(c).cast("array<double>") for c in ("user_factors", "item_factors")})


def score_pairs(
    model: ALSModel,
    rows: DataFrame,
    unknown: float | None = 0.0,
    user: str = USER_INDEX,
    item: str = ITEM_INDEX,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows with column ``prediction``. Unknown ids score ``unknown``; with None they vanish."""
    scored = _with_factors(model, rows, user, item, hot)
    prediction = F.when(
        F.col("user_factors").isNotNull() & F.col("item_factors").isNotNull(),
        dot("user_factors", "item_factors"),
    )
    scored = scored.select(*rows.columns, prediction.alias("prediction"))
    if unknown is None:
        return scored.filter(F.col("prediction").isNotNull())
    return scored.fillna(unknown, subset=["prediction"])


def fit_explicit(
    ratings_table: DataFrame,
    user: str,
    item: str,
    rating: str,
    seed: int = SEED,
    blocks: int = BLOCKS,
) -> ALSModel:
    """Explicit-rating factors of default rank."""
    als = ALS(
        maxIter=ITERATIONS,
        regParam=REGULARISATION,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        seed=seed,
    )
    return _fit(als, materialize(ratings_table.select(user, item, rating)), blocks)


def explicit_error(model: ALSModel, rows: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row: ``rmse`` over the pairs whose ids both have factors, and how many pairs have and lack them."""
    scored = score_pairs(model, rows, unknown=float("nan"), user=user, item=item)
    known = ~F.isnan("prediction")
    error = F.when(known, F.col(rating) - F.col("prediction"))
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.when(known, 1)).alias("scored"),
        F.count(F.when(~known, 1)).alias("without_factors"),
    )


def recommendations(nested: DataFrame, key: str, other: str) -> DataFrame:
    """(key, other, score, rank) from the nested lists of the ``recommendFor...`` methods."""
    ranked = nested.select(key, F.posexplode("recommendations").alias("position", "entry"))
    return ranked.select(
        key,
        F.col(f"entry.{other}").alias(other),
        F.col("entry.rating").cast("double").alias("score"),
        (F.col("position") + 1).alias("rank"),
    )


def grid_search(
    train: DataFrame,
    test: DataFrame,
    thresholds: Sequence[float],
    labels: Sequence[str] = tuple(LABELS),
    alphas: Sequence[float] = (1.0, 10.0),
    ranks: Sequence[int] = (10, 50),
    seed: int = SEED,
) -> DataFrame:
    """(engagement, alpha, rank, log_loss, skipped, areaUnderPR-<t>...) for each setting."""
    results = []
    hot = frequent_ids(test)
    for label in labels:
        rated = materialize(ratings(train, label))
        judged = test.select(USER_INDEX, ITEM_INDEX, label)
        for alpha in alphas:
            for rank in ranks:
                model = fit_implicit(train, label, rank, alpha, seed, rated=rated)
                scored = score_pairs(model, judged, hot=hot)
                table = evaluation.evaluation_table(scored, label, {"mf": "prediction"}, thresholds)
                results.append(
                    table.drop("model_name").select(
                        F.lit(label).alias("engagement"),
                        F.lit(float(alpha)).alias("alpha"),
                        F.lit(rank).alias("rank"),
                        "*",
                    )
                )
    return reduce(DataFrame.unionByName, results)


def factor_features(model: ALSModel, rows: DataFrame) -> DataFrame:
    """Rows with the factors of their user and item joined into one vector, zeros for unknown ids."""
    zeros = F.array_repeat(F.lit(0.0), model.rank)
    both = F.concat(F.coalesce("user_factors", zeros), F.coalesce("item_factors", zeros))
    joined = _with_factors(model, rows, USER_INDEX, ITEM_INDEX, None)
    return joined.select(*rows.columns, array_to_vector(both).alias("factors"))


def fit_neural(
    features: DataFrame, label: str, rank: int, iterations: int = 20, seed: int = SEED
) -> MultilayerPerceptronClassificationModel:
    """Feed-forward net 2k -> k -> k/2 -> two classes on the joined factors of rank k."""
    net = MultilayerPerceptronClassifier(
        featuresCol="factors",
        labelCol=label,
        layers=[2 * rank, rank, max(1, rank // 2), 2],
        maxIter=iterations,
        seed=seed,
    )
    return net.fit(features)


def neural_scores(model: MultilayerPerceptronClassificationModel, features: DataFrame) -> DataFrame:
    """Rows with the probability of the engagement as ``prediction``; keys stay in the row."""
    scored = model.transform(features)
    p = vector_to_array("probability")[1]
    return scored.drop("prediction").withColumn("prediction", p).drop(
        "factors", "rawPrediction", "probability"
    )
