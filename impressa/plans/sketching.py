"""Sketches by part, stored, merged and held against exact answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from impressa.operators import sketches
from impressa.plans.registry import query
from impressa.session import delete_at_end, materialize, scratch_path
from impressa.sources.readers import read_table

# Largest errors that are taken as right: of a distinct count, relative; of a quantile, in rank.
_COUNT_ERROR, _RANK_ERROR = 0.04, 0.02


@query(
    "sketch_estimates",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, TRUE AS users_close,
              TRUE AS median_close, TRUE AS high_close
       FROM events GROUP BY 1""",
)
def sketch_estimates(spark, folder):
    """Distinct users and value quantiles by event type, from sketches of 8 parts stored one after the other."""
    events = read_table(spark, folder, "events").withColumn("part", F.pmod("event_id", F.lit(8)))
    path = scratch_path(spark)
    delete_at_end(spark, path)
    built = sketches.part_sketches(events, ["part", "event_type"], ["user_id"], ["value"])
    for half in (F.col("part") < 4, F.col("part") >= 4):
        sketches.store_parts(built.filter(half), path, "part")
    joined = sketches.merged(sketches.read_parts(spark, path), ["event_type"])
    told = materialize(sketches.estimates(joined, [0.5, 0.9]).withColumnRenamed("n", "counted"))
    quantile = [F.col("quantiles_value")[i] for i in (0, 1)]
    exact = (
        events.join(F.broadcast(told.select("event_type", "quantiles_value")), "event_type")
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct("user_id").alias("users"),
            *[F.avg((F.col("value") <= q).cast("double")).alias(f"upto{i}") for i, q in enumerate(quantile)],
        )
    )
    both = exact.join(told, "event_type").filter(F.col("n") == F.col("counted"))
    return both.select(
        "event_type",
        "n",
        "users",
        (F.abs(F.col("distinct_user_id") - F.col("users")) <= _COUNT_ERROR * F.col("users")).alias("users_close"),
        (F.abs(F.col("upto0") - 0.5) <= _RANK_ERROR).alias("median_close"),
        (F.abs(F.col("upto1") - 0.9) <= _RANK_ERROR).alias("high_close"),
    )
