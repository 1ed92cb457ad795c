"""The event, document and customer tables seen as an impression log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.functions.hashing import HASH_RANGE, key_hash
from impressa.functions.labels import with_labels
from impressa.functions.text import WHITESPACE
from impressa.sources import schemas
from impressa.sources.readers import read_table
from impressa.sources.schemas import ITEM, LABELS, USER

# The event type that stands for each engagement.
EVENT_OF_LABEL = {
    "like": "click",
    "reply": "signup",
    "retweet": "purchase",
    "retweet_with_comment": "error",
}


def _seconds() -> Column:
    return F.unix_seconds(F.col("ts").cast("timestamp"))


def exposures(spark: SparkSession, folder: str) -> DataFrame:
    """Events as (row_id, user, item, tweet_timestamp, value, four engagement timestamps)."""
    stamps = [
        F.when(F.col("event_type") == event, _seconds()).alias(f"{label}_timestamp")
        for label, event in EVENT_OF_LABEL.items()
    ]
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("string").alias(USER),
        F.get_json_object("props", "$.k").alias(ITEM),
        _seconds().alias("tweet_timestamp"),
        "value",
        *stamps,
    )


def interactions(spark: SparkSession, folder: str, dtype: str = "int") -> DataFrame:
    """(row_id, user, item, value, four 0/1 labels)."""
    labelled = with_labels(exposures(spark, folder), dtype)
    return labelled.select("row_id", USER, ITEM, "value", *LABELS)


def scored_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions with a score made of the event value."""
    return interactions(spark, folder).withColumn("score", F.col("value") / 500)


def item_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(item, text) of the documents."""
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias(ITEM), "text"
    )


def item_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Log columns that belong to the item. Lists are tab-separated, some are null."""
    documents = read_table(spark, folder, "documents")
    words = F.array_remove(F.split("text", WHITESPACE), "")
    size = F.col("n_chars")
    media = (
        F.when(F.pmod(size, F.lit(4)) == 1, "Photo")
        .when(F.pmod(size, F.lit(4)) == 2, "Photo\tPhoto")
        .when(F.pmod(size, F.lit(4)) == 3, "Video")
    )
    tags = F.when(F.pmod(size, F.lit(3)) != 0, F.concat_ws("\t", "source", "lang"))
    return documents.select(
        F.col("doc_id").cast("string").alias(ITEM),
        F.array_join(words, "\t").alias("text_tokens"),
        tags.alias("hashtags"),
        media.alias("present_media"),
        F.lit(None).cast("string").alias("present_links"),
        F.lit(None).cast("string").alias("present_domains"),
        F.col("lang").alias("language"),
        F.col("source").alias("engaged_with_user_id"),
        size.alias("engaged_with_user_follower_count"),
        F.pmod(size, F.lit(997)).alias("engaged_with_user_following_count"),
        (F.pmod(size, F.lit(5)) == 0).alias("engaged_with_user_is_verified"),
        (F.lit(1_500_000_000) + size).alias("engaged_with_user_account_creation"),
    )


def user_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Log columns that belong to the reader."""
    balance = F.col("c_acctbal")
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias(USER),
        F.col("c_mktsegment").alias("tweet_type"),
        F.floor(balance + 1000).alias("engaging_user_follower_count"),
        F.col("c_nationkey").cast("bigint").alias("engaging_user_following_count"),
        (balance > 0).alias("engaging_user_is_verified"),
        (F.lit(1_400_000_000) + F.col("c_custkey")).alias("engaging_user_account_creation"),
    )


def attach(shown: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Exposures with the attributes of their item and user.

    Plain joins: small attribute tables are broadcast, and the rows of a frequent item or user are
    split by the adaptive skew join, so that no job runs before the caller asks for rows.
    """
    # Readers first, while rows are narrow; the attributes of an item hold its text.
    return attach_items(attach_readers(shown, users), items)


def attach_readers(shown: DataFrame, users: DataFrame) -> DataFrame:
    """Exposures with the attributes of their user, and what belongs to the row alone."""
    return shown.join(users, USER).withColumn("engaged_follows_engaging", F.pmod(F.col("row_id"), F.lit(2)) == 0)


def attach_items(log: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of :func:`attach_readers` with the attributes of their item."""
    return log.join(items, ITEM)


def impressions(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """The whole 24-column impression log with a row id in front.

    The text of an item is attached to each of its impressions, as in a raw log. With ``spread`` exposures
    are dealt out evenly to an explicit number of tasks first, for readers of the whole texts.
    """
    shown = exposures(spark, folder)
    if spread:
        shown = shown.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row_id")
    log = attach(shown, item_attributes(spark, folder), user_attributes(spark, folder))
    return log.select("row_id", *schemas.RAW_LOG.names)


def model_scores(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Three score tables (user, item, <model>), one row per impression, keys repeated.

    They differ in coverage, as predictions of separately trained models do.
    """
    log = exposures(spark, folder).select("row_id", USER, ITEM, "value")
    noise = key_hash(3, USER, ITEM) / HASH_RANGE
    return {
        "mf": log.filter(F.col("value") >= 5).select(USER, ITEM, (F.col("value") / 500).alias("mf")),
        "rf": log.select(USER, ITEM, (0.1 + 0.8 * noise).alias("rf")),
        "nncf": log.filter(F.col("value") < 200).select(
            USER, ITEM, (1 / (1 + F.col("value"))).alias("nncf")
        ),
    }


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """(user, item, rating): customers, parts and the mean quantity ordered."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.avg("l_quantity").alias("rating"))
    )
