"""Splits, bootstrap samples, cohorts and folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.operators import bootstrap, sampling
from impressa.plans import oracle
from impressa.plans.registry import query
from impressa.sources import views
from impressa.sources.schemas import ITEM, KEYS, USER

# Fixed values: (name, rows, seed) of the three bootstrap samples.
SAMPLES = [("train", 40_000, 19), ("ensemble_train", 5_000, 20), ("test", 5_000, 21)]


@query(
    "train_test_split",
    f"""SELECT event_id AS row_id,
               CASE WHEN {oracle.key_hash(42, 'event_id')} < {oracle.bound(0.9)} THEN 'train' ELSE 'test' END AS part
        FROM events""",
)
def train_test_split(spark, folder):
    train, test = sampling.split(views.interactions(spark, folder), 0.9, 42, "row_id")
    return train.select("row_id", F.lit("train").alias("part")).unionByName(
        test.select("row_id", F.lit("test").alias("part"))
    )


@query(
    "split_fixed_test_size",
    f"""SELECT event_id AS row_id, CASE WHEN row_number() OVER (ORDER BY {oracle.key_hash(42, 'event_id')}, event_id)
               <= 1000 THEN 'test' ELSE 'train' END AS part FROM events""",
)
def split_fixed_test_size(spark, folder):
    train, test = sampling.split_fixed_size(views.interactions(spark, folder), 1000, 42, "row_id")
    return train.select("row_id", F.lit("train").alias("part")).unionByName(
        test.select("row_id", F.lit("test").alias("part"))
    )


def _bootstrap_sql() -> str:
    numbered = "numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS id FROM events)"
    draws = ", ".join(
        f"""{name} AS (SELECT '{name}' AS sample, i AS draw,
            {oracle.key_hash(seed, 'i')} % (SELECT count(*) FROM events) AS id FROM range({n}) t(i))"""
        for name, n, seed in SAMPLES
    )
    union = " UNION ALL ".join(f"SELECT * FROM {name}" for name, _, _ in SAMPLES)
    return f"""WITH {numbered}, {draws}
        SELECT sample, draw, event_id AS row_id, CAST(user_id AS VARCHAR) AS engaging_user_id,
               props->>'$.k' AS tweet_id
        FROM ({union}) JOIN numbered USING (id)"""


@query("bootstrap_sample", _bootstrap_sql())
def bootstrap_sample(spark, folder):
    log = views.interactions(spark, folder).select("row_id", *KEYS)
    numbered = sampling.number_keys(log, "row_id")
    parts = [
        sampling.bootstrap(log, n, seed, "row_id", numbered).withColumn("sample", F.lit(name))
        for name, n, seed in SAMPLES
    ]
    return reduce(DataFrame.unionByName, parts).select("sample", "draw", "row_id", USER, ITEM)


@query("bootstrap_by_ranges")
def bootstrap_by_ranges(spark, folder):
    """The same three samples by splitting the draws down a tree of hash ranges; other draws than above."""
    log = views.interactions(spark, folder).select("row_id", *KEYS)
    parts = [
        bootstrap.bootstrap(log, n, seed, "row_id").withColumn("sample", F.lit(name)) for name, n, seed in SAMPLES
    ]
    return reduce(DataFrame.unionByName, parts).select("sample", "draw", "row_id", USER, ITEM)


@query(
    "sample_user_cohort",
    f"""WITH {oracle.INTERACTIONS},
        chosen AS (SELECT DISTINCT engaging_user_id, {oracle.key_hash(7, 'engaging_user_id')} AS h
                   FROM interactions ORDER BY h, engaging_user_id LIMIT 100)
        SELECT row_id, engaging_user_id, tweet_id FROM interactions
        WHERE engaging_user_id IN (SELECT engaging_user_id FROM chosen)""",
)
def sample_user_cohort(spark, folder):
    log = views.interactions(spark, folder).select("row_id", *KEYS)
    return sampling.sample_cohort(log, USER, 100, 7)


@query(
    "kfold_assignment",
    f"SELECT event_id AS row_id, CAST({oracle.key_hash(42, 'event_id')} % 5 AS INTEGER) AS fold FROM events",
)
def kfold_assignment(spark, folder):
    return views.interactions(spark, folder).select(
        "row_id", sampling.fold_number(5, 42, "row_id").alias("fold")
    )
