"""Common table expressions of the oracle SQL, spelled out independently of the Spark code."""

from __future__ import annotations

EXPOSURES = """
exposures AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS engaging_user_id,
         props->>'$.k' AS tweet_id, CAST(floor(epoch(ts)) AS BIGINT) AS tweet_timestamp, value,
         CASE WHEN event_type = 'click' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS like_timestamp,
         CASE WHEN event_type = 'signup' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS reply_timestamp,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS retweet_timestamp,
         CASE WHEN event_type = 'error' THEN CAST(floor(epoch(ts)) AS BIGINT) END
           AS retweet_with_comment_timestamp
  FROM events)"""

INTERACTIONS = """
interactions AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS engaging_user_id,
         props->>'$.k' AS tweet_id, value, value / 500 AS score,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS "like",
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS reply,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS retweet,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS retweet_with_comment
  FROM events)"""

# One row per interaction and label.
LONG_LABELS = """
long_labels AS (
  SELECT 'like' AS label, "like" AS y, score, tweet_id, engaging_user_id FROM interactions
  UNION ALL SELECT 'reply', reply, score, tweet_id, engaging_user_id FROM interactions
  UNION ALL SELECT 'retweet', retweet, score, tweet_id, engaging_user_id FROM interactions
  UNION ALL SELECT 'retweet_with_comment', retweet_with_comment, score, tweet_id, engaging_user_id
            FROM interactions)"""

IMPRESSIONS = """
impressions AS (
  SELECT e.event_id AS row_id, CAST(e.user_id AS VARCHAR) AS engaging_user_id,
         e.props->>'$.k' AS tweet_id, e.event_type, CAST(floor(epoch(e.ts)) AS BIGINT) AS tweet_timestamp,
         CASE WHEN d.n_chars % 3 <> 0 THEN concat_ws(chr(9), d.source, d.lang) END AS hashtags,
         CASE d.n_chars % 4 WHEN 1 THEN 'Photo' WHEN 2 THEN 'Photo' || chr(9) || 'Photo'
              WHEN 3 THEN 'Video' END AS present_media,
         c.c_mktsegment AS tweet_type, d.lang AS language, d.text,
         d.n_chars AS engaged_with_user_follower_count,
         d.n_chars % 997 AS engaged_with_user_following_count,
         d.n_chars % 5 = 0 AS engaged_with_user_is_verified,
         1500000000 + d.n_chars AS engaged_with_user_account_creation,
         CAST(floor(c.c_acctbal + 1000) AS BIGINT) AS engaging_user_follower_count,
         CAST(c.c_nationkey AS BIGINT) AS engaging_user_following_count,
         c.c_acctbal > 0 AS engaging_user_is_verified,
         1400000000 + c.c_custkey AS engaging_user_account_creation
  FROM events e JOIN documents d ON d.doc_id = CAST(e.props->>'$.k' AS BIGINT)
                JOIN customer c ON c.c_custkey = e.user_id)"""


def key_hash(seed: int, *keys: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 15) AS BIGINT)"


def bound(fraction: float) -> int:
    return int(fraction * 2**60)


MODEL_SCORES = f"""
mf AS (SELECT CAST(user_id AS VARCHAR) AS engaging_user_id, props->>'$.k' AS tweet_id,
              avg(value / 500) AS mf FROM events WHERE value >= 5 GROUP BY 1, 2),
rf AS (SELECT CAST(user_id AS VARCHAR) AS engaging_user_id, props->>'$.k' AS tweet_id,
              avg(0.1::DOUBLE + 0.8::DOUBLE *
                  (CAST({key_hash(3, "CAST(user_id AS VARCHAR)", "props->>'$.k'")} AS DOUBLE) / 1152921504606846976))
                AS rf FROM events GROUP BY 1, 2),
nncf AS (SELECT CAST(user_id AS VARCHAR) AS engaging_user_id, props->>'$.k' AS tweet_id,
                avg(1 / (1 + value)) AS nncf FROM events WHERE value < 200 GROUP BY 1, 2)"""

TERMS = r"""
tokenized AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS tokens
  FROM documents),
counts AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS term FROM tokenized) GROUP BY 1, 2)"""
