"""Fixed shapes of the tables that are read and written."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "tinyint": T.ByteType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def struct(fields: str) -> T.StructType:
    """A schema from ``name type, name type``, without the need of a session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Label names, key names and the column order of the raw impression log.
LABELS = ["like", "reply", "retweet", "retweet_with_comment"]
USER = "engaging_user_id"
ITEM = "tweet_id"
KEYS = [USER, ITEM]
FIELD_SEPARATOR = "\x01"

RAW_LOG = struct(
    """
    text_tokens string, hashtags string, tweet_id string,
    present_media string, present_links string, present_domains string,
    tweet_type string, language string, tweet_timestamp bigint,
    engaged_with_user_id string,
    engaged_with_user_follower_count bigint, engaged_with_user_following_count bigint,
    engaged_with_user_is_verified boolean, engaged_with_user_account_creation bigint,
    engaging_user_id string,
    engaging_user_follower_count bigint, engaging_user_following_count bigint,
    engaging_user_is_verified boolean, engaging_user_account_creation bigint,
    engaged_follows_engaging boolean,
    reply_timestamp bigint, retweet_timestamp bigint,
    retweet_with_comment_timestamp bigint, like_timestamp bigint
    """
)

# Roles of the log columns in the feature vector.
CATEGORY_COLUMNS = ["tweet_type", "present_media", "language"]
BOOLEAN_COLUMNS = [
    "engaged_with_user_is_verified",
    "engaging_user_is_verified",
    "engaged_follows_engaging",
]
NUMERIC_COLUMNS = [
    "tweet_timestamp",
    "engaged_with_user_account_creation",
    "engaging_user_account_creation",
    "engaged_with_user_follower_count",
    "engaged_with_user_following_count",
    "engaging_user_follower_count",
    "engaging_user_following_count",
]

INDEXED_INTERACTIONS = struct(
    "tweet_id_index int, engaging_user_id_index int, "
    + ", ".join(f"{label} tinyint" for label in LABELS)
)
PREDICTIONS = struct("engaging_user_id string, tweet_id string, prediction double")
PRINTED_PREDICTIONS = struct(
    "tweet_id string, engaging_user_id string, probability string, prediction double"
)
RATINGS = struct("userId int, movieId int, rating double, timestamp bigint")


def id_index(id_column: str) -> T.StructType:
    return struct(f"{id_column} string, {id_column}_index bigint")
