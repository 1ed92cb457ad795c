"""Tables written as delimited text under the scratch folder and read back through the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.operators import ids
from impressa.operators.joins import join_labels, join_predictions
from impressa.plans import oracle
from impressa.plans.registry import query
from impressa.session import delete_at_end, materialize, scratch_path
from impressa.sources import onefile, quarantine, readers, views, writers
from impressa.sources.schemas import (
    FIELD_SEPARATOR, INDEXED_INTERACTIONS, ITEM, KEYS, LABELS, PREDICTIONS, RAW_LOG, USER,
)


_LOG = f"""{oracle.IMPRESSIONS},
log AS (
  SELECT tweet_id, engaging_user_id, hashtags, present_media, tweet_type, language, tweet_timestamp,
         len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))::INTEGER AS n_tokens,
         engaged_with_user_follower_count, engaged_with_user_is_verified, engaging_user_is_verified,
         engaging_user_account_creation, row_id % 2 = 0 AS engaged_follows_engaging,
         CASE WHEN event_type = 'click' THEN tweet_timestamp END AS like_timestamp,
         CASE WHEN event_type = 'error' THEN tweet_timestamp END AS retweet_with_comment_timestamp
  FROM impressions)"""
_LOG_COLUMNS = [
    ITEM, USER, "hashtags", "present_media", "tweet_type", "language", "tweet_timestamp",
    "engaged_with_user_follower_count", "engaged_with_user_is_verified", "engaging_user_is_verified",
    "engaging_user_account_creation", "engaged_follows_engaging", "like_timestamp",
    "retweet_with_comment_timestamp",
]


def _write_log(spark: SparkSession, folder: str, path: str) -> None:
    """The log as compressed text: every row repeats the whole text of its item.

    Exposures are dealt out while they are narrow, as rows grow a lot where the texts come in.
    """
    writers.write_sample(views.impressions(spark, folder, spread=True), path, row_id="row_id", compression="gzip")


def _shown(log: DataFrame) -> DataFrame:
    tokens = F.size(F.array_remove(F.split("text_tokens", "\t"), "")).alias("n_tokens")
    return log.select(*_LOG_COLUMNS, tokens)


@query("raw_log_round_trip", f"WITH {_LOG} SELECT * FROM log")
def raw_log_round_trip(spark, folder):
    """The 24-column log without header and row number."""
    path = scratch_path(spark)
    _write_log(spark, folder, path)
    delete_at_end(spark, path)
    return _shown(readers.read_raw_log(spark, path))


@query("raw_log_to_parquet", f"WITH {_LOG} SELECT * FROM log WHERE language = 'fr'")
def raw_log_to_parquet(spark, folder):
    """The log converted to Parquet, where the filter is pushed into the scan."""
    text, table = scratch_path(spark), scratch_path(spark)
    _write_log(spark, folder, text)
    readers.raw_log_to_parquet(spark, text, table)
    for path in (text, table):
        delete_at_end(spark, path)
    return _shown(spark.read.schema(RAW_LOG).parquet(table).filter("language = 'fr'"))


@query(
    "quarantine_round_trip",
    f"""WITH {oracle.IMPRESSIONS}
        SELECT row_id, CASE WHEN row_id % 11 = 0 THEN 'width' WHEN row_id % 7 = 0 THEN 'type' ELSE 'good' END AS outcome,
               CASE WHEN row_id % 11 <> 0 AND row_id % 7 = 0 THEN 'tweet_timestamp' END AS "column",
               CASE WHEN row_id % 11 <> 0 AND row_id % 7 <> 0 THEN tweet_timestamp END AS tweet_timestamp
        FROM impressions""",
)
def quarantine_round_trip(spark, folder):
    """A log in which some lines lost a cell and others have a word for a time; good and bad lines are all lines.

    The first cell carries the row number, so that every line can be told.
    """
    log = views.impressions(spark, folder, spread=True)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_LOG.names]
    cells[0] = F.col("row_id").cast("string")
    time = RAW_LOG.names.index("tweet_timestamp")
    cells[time] = F.when(F.col("row_id") % 7 == 0, F.lit("late")).otherwise(cells[time])
    whole, short = F.concat_ws(FIELD_SEPARATOR, *cells), F.concat_ws(FIELD_SEPARATOR, *cells[:-1])
    path = scratch_path(spark)
    log.select(F.when(F.col("row_id") % 11 == 0, short).otherwise(whole).alias("value")).write.text(path)
    delete_at_end(spark, path)
    good, bad = quarantine.read_checked(spark, path)
    kept = good.select(
        F.col("text_tokens").cast("bigint").alias("row_id"), F.lit("good").alias("outcome"),
        F.lit(None).cast("string").alias("column"), "tweet_timestamp",
    )
    number = F.substring_index("line", FIELD_SEPARATOR, 1).cast("bigint")
    return kept.unionByName(
        bad.select(
            number.alias("row_id"), F.col("reason").alias("outcome"), "column",
            F.lit(None).cast("bigint").alias("tweet_timestamp"),
        )
    )


@query(
    "one_file_round_trip",
    f"""WITH {oracle.INTERACTIONS}
        SELECT engaging_user_id, tweet_id, round(value / 500, 6) AS prediction FROM interactions""",
)
def one_file_round_trip(spark, folder):
    """Scores of all impressions as one file with a header, joined from parts, read back."""
    path = f"{scratch_path(spark)}/scores.csv"
    scored = views.scored_interactions(spark, folder).select(*KEYS, F.round("score", 6).alias("prediction"))
    onefile.write_one_file(scored, path)
    delete_at_end(spark, path)
    return readers.read_delimited(spark, path, PREDICTIONS)


_INDEXED = f"""{oracle.INTERACTIONS},
items AS (SELECT tweet_id, row_number() OVER (ORDER BY tweet_id) - 1 AS tweet_id_index
          FROM (SELECT DISTINCT tweet_id FROM interactions)),
users AS (SELECT engaging_user_id, row_number() OVER (ORDER BY engaging_user_id) - 1 AS engaging_user_id_index
          FROM (SELECT DISTINCT engaging_user_id FROM interactions))"""


@query(
    "indexed_round_trip",
    f"""WITH {_INDEXED}
        SELECT tweet_id_index::INTEGER AS tweet_id_index, engaging_user_id_index::INTEGER AS engaging_user_id_index,
               {', '.join(f'"{e}"::TINYINT AS "{e}"' for e in LABELS)}
        FROM interactions JOIN items USING (tweet_id) JOIN users USING (engaging_user_id)""",
)
def indexed_round_trip(spark, folder):
    """Interactions encoded by indexes that were read back, written with a header, read by name."""
    log = views.interactions(spark, folder, "tinyint")
    indexes = {}
    for column in (ITEM, USER):
        path = scratch_path(spark)
        writers.write_delimited(ids.dense_id_index(log, column), path)
        delete_at_end(spark, path)
        indexes[column] = readers.read_id_index(spark, path, column)
    path = scratch_path(spark)
    writers.write_delimited(ids.encode_ids(log, indexes).select(*INDEXED_INTERACTIONS.names), path)
    delete_at_end(spark, path)
    return readers.read_indexed_interactions(spark, path)


@query(
    "id_list_round_trip",
    f"""WITH {oracle.INTERACTIONS} SELECT DISTINCT engaging_user_id FROM interactions WHERE "like" = 1""",
)
def id_list_round_trip(spark, folder):
    """One column without header."""
    liked = views.interactions(spark, folder).filter("like = 1").select(USER).distinct()
    path = scratch_path(spark)
    liked.write.csv(path)
    delete_at_end(spark, path)
    return readers.read_id_list(spark, path, USER)


@query(
    "predictions_round_trip",
    f"""WITH {oracle.INTERACTIONS}
        SELECT engaging_user_id, tweet_id, 'like' AS engagement, round(avg(value / 500), 9) AS score,
               max("like")::TINYINT AS label
        FROM interactions GROUP BY 1, 2""",
)
def predictions_round_trip(spark, folder):
    """Scores written by engagement and labels written with a header, read back and joined.

    Every impression is written. Repeated pairs have their scores averaged; a pair is engaged if one of
    its impressions is.
    """
    log = materialize(views.scored_interactions(spark, folder))
    scores, labels = scratch_path(spark), scratch_path(spark)
    scored = log.select(*KEYS, F.col("score").alias("prediction"), F.lit("like").alias("engagement"))
    writers.write_by_label(scored, scores)
    writers.write_delimited(log.select(*KEYS, "like"), labels)
    for path in (scores, labels):
        delete_at_end(spark, path)
    read = readers.read_predictions(spark, {"score": f"{scores}/engagement=like"}, {"score": "\x01"})["score"]
    reduced = readers.read_labels(spark, labels, "like").groupBy(*KEYS).agg(F.max("label").alias("label"))
    joined = join_labels(join_predictions({"score": read}, KEYS), reduced, KEYS)
    return joined.select(*KEYS, F.lit("like").alias("engagement"), F.round("score", 9).alias("score"), "label")


@query(
    "ratings_round_trip",
    """SELECT o_custkey::INTEGER AS "userId", l_partkey::INTEGER AS "movieId", avg(l_quantity) AS rating,
              CAST(NULL AS BIGINT) AS timestamp
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def ratings_round_trip(spark, folder):
    """Comma-separated with a header; the empty time reads as null."""
    rated = views.purchases(spark, folder).select(
        F.col("user").alias("userId"), F.col("item").alias("movieId"), "rating",
        F.lit(None).cast("bigint").alias("timestamp"),
    )
    path = scratch_path(spark)
    writers.write_delimited(rated, path, sep=",")
    delete_at_end(spark, path)
    return readers.read_ratings(spark, path)
