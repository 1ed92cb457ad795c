"""Scans, projections, joins, aggregations, numbering, limits and set operations."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.functions import labels as L
from impressa.functions import similarity, text
from impressa.operators import aggregates, cleaning, colocated, ids, ordering
from impressa.operators.coldstart import full_train, missing_ids, partnered_fill, zipped_fill
from impressa.operators.joins import join_labels, join_predictions, spread_join
from impressa.plans import oracle
from impressa.plans.registry import query
from impressa.session import materialize
from impressa.sources import views, writers
from impressa.sources.readers import read_table
from impressa.sources.schemas import ITEM, KEYS, LABELS, USER

EXPOSURES, INTERACTIONS = oracle.EXPOSURES, oracle.INTERACTIONS
LABEL_LIST = '"like", reply, retweet, retweet_with_comment'

# ---------------------------------------------------------------- scans and projections


@query(
    "scan_parquet",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")


@query(
    "project_drop",
    f"WITH {EXPOSURES} SELECT * EXCLUDE (tweet_timestamp, value) FROM exposures",
)
def project_drop(spark, folder):
    # A name that is not a column is accepted, as in any drop.
    return views.exposures(spark, folder).drop("tweet_timestamp", "value", "engaged_user_id")


@query(
    "project_select",
    f"WITH {EXPOSURES} SELECT row_id, engaging_user_id, tweet_id, like_timestamp FROM exposures",
)
def project_select(spark, folder):
    return views.exposures(spark, folder).select("row_id", USER, ITEM, "like_timestamp")


@query(
    "project_rename",
    f"""WITH {INTERACTIONS} SELECT row_id, tweet_id AS item, engaging_user_id AS "user", "like" AS liked
        FROM interactions""",
)
def project_rename(spark, folder):
    renamed = views.interactions(spark, folder).withColumnsRenamed(
        {ITEM: "item", USER: "user", "like": "liked"}
    )
    return renamed.select("row_id", "item", "user", "liked")


@query(
    "project_cast",
    """SELECT event_id, TRY_CAST(props->>'$.k' AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS bad,
              TRY_CAST(CAST(user_id AS VARCHAR) AS DOUBLE) AS user_double,
              CAST(CASE WHEN value > 50 THEN 1 ELSE 0 END AS TINYINT) AS flag
       FROM events""",
)
def project_cast(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.col("event_type").try_cast("bigint").alias("bad"),
        F.col("user_id").cast("string").try_cast("double").alias("user_double"),
        F.when(F.col("value") > 50, 1).otherwise(0).cast("tinyint").alias("flag"),
    )


@query(
    "labels_from_timestamps",
    f"""WITH {EXPOSURES}
        SELECT row_id, CASE WHEN like_timestamp IS NULL THEN 0 ELSE 1 END AS "like",
               CASE WHEN reply_timestamp IS NULL THEN 0 ELSE 1 END AS reply,
               CASE WHEN retweet_timestamp IS NULL THEN 0 ELSE 1 END AS retweet,
               CASE WHEN retweet_with_comment_timestamp IS NULL THEN 0 ELSE 1 END AS retweet_with_comment
        FROM exposures""",
)
def labels_from_timestamps(spark, folder):
    return views.exposures(spark, folder).select("row_id", *L.label_columns("int"))


@query(
    "labels_from_timestamps_byte",
    f"""WITH {EXPOSURES}
        SELECT row_id, engaging_user_id, tweet_id,
               CAST(like_timestamp IS NOT NULL AS TINYINT) AS "like",
               CAST(reply_timestamp IS NOT NULL AS TINYINT) AS reply,
               CAST(retweet_timestamp IS NOT NULL AS TINYINT) AS retweet,
               CAST(retweet_with_comment_timestamp IS NOT NULL AS TINYINT) AS retweet_with_comment
        FROM exposures""",
)
def labels_from_timestamps_byte(spark, folder):
    exposures = views.exposures(spark, folder).drop("tweet_timestamp", "value")
    return L.with_labels(exposures, "tinyint")


@query(
    "fill_null_constant",
    f"""WITH {oracle.IMPRESSIONS}
        SELECT row_id, coalesce(hashtags, 'none') AS hashtags, coalesce(present_media, 'none') AS present_media
        FROM impressions""",
)
def fill_null_constant(spark, folder):
    log = views.impressions(spark, folder).select("row_id", "hashtags", "present_media")
    return log.fillna("none", subset=["hashtags", "present_media"])


@query(
    "threshold_predictions",
    """SELECT event_id AS row_id, value / 500 AS prediction,
              CASE WHEN value / 500 >= 0.1 THEN 1 ELSE 0 END AS prediction_bool
       FROM events""",
)
def threshold_predictions(spark, folder):
    scored = views.scored_interactions(spark, folder)
    return scored.select(
        "row_id",
        F.col("score").alias("prediction"),
        L.at_least("score", 0.1).alias("prediction_bool"),
    )


@query(
    "struct_field",
    f"WITH {EXPOSURES} SELECT row_id, tweet_id, tweet_timestamp FROM exposures",
)
def struct_field(spark, folder):
    packed = views.exposures(spark, folder).select(
        "row_id", F.struct(ITEM, "tweet_timestamp").alias("_1")
    )
    return packed.select(
        "row_id",
        F.col("_1").getField(ITEM).alias(ITEM),
        F.col("_1").getField("tweet_timestamp").alias("tweet_timestamp"),
    )


@query(
    "count_by_flag",
    f"""WITH {oracle.IMPRESSIONS}
        SELECT engaging_user_is_verified, count(*) AS n FROM impressions GROUP BY 1""",
)
def count_by_flag(spark, folder):
    log = views.impressions(spark, folder)
    return log.groupBy("engaging_user_is_verified").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- scalar functions


@query(
    "tokenize",
    f"""WITH {oracle.TERMS}
        SELECT doc_id, array_to_string(tokens, ' ') AS joined, CAST(len(tokens) AS INTEGER) AS n_tokens
        FROM tokenized""",
)
def tokenize(spark, folder):
    words = text.tokens("text", text.WHITESPACE)
    return read_table(spark, folder, "documents").select(
        "doc_id", F.array_join(words, " ").alias("joined"), F.size(words).alias("n_tokens")
    )


@query(
    "media_category",
    f"""WITH {oracle.IMPRESSIONS}
        SELECT row_id, CASE WHEN present_media IS NULL THEN '[none]'
               ELSE '[' || replace(lower(present_media), chr(9), ', ') || ']' END AS media
        FROM impressions""",
)
def media_category(spark, folder):
    log = views.impressions(spark, folder).fillna("none", subset=["present_media"])
    items = text.tokens("present_media", text.WHITESPACE)
    return log.select("row_id", text.list_category(items).alias("media"))


@query(
    "split_lists",
    f"""WITH {oracle.IMPRESSIONS}
        SELECT row_id, CAST(len(string_split(hashtags, chr(9))) AS INTEGER) AS n_hashtags,
               string_split(hashtags, chr(9))[1] AS first_hashtag, string_split(present_media, chr(9))[2] AS second_media
        FROM impressions""",
)
def split_lists(spark, folder):
    log = views.impressions(spark, folder)
    tags, media = text.list_items("hashtags"), text.list_items("present_media")
    return log.select(
        "row_id",
        F.when(tags.isNotNull(), F.size(tags)).alias("n_hashtags"),
        F.get(tags, 0).alias("first_hashtag"),
        F.get(media, 1).alias("second_media"),
    )


@query(
    "epoch_to_timestamp",
    f"""WITH {EXPOSURES}
        SELECT row_id, make_timestamp(tweet_timestamp * 1000000) AS posted_at,
               make_timestamp(like_timestamp * 1000000) AS liked_at FROM exposures""",
)
def epoch_to_timestamp(spark, folder):
    return views.exposures(spark, folder).select(
        "row_id",
        F.timestamp_seconds("tweet_timestamp").cast("timestamp_ntz").alias("posted_at"),
        F.timestamp_seconds("like_timestamp").cast("timestamp_ntz").alias("liked_at"),
    )


@query(
    "cosine_pairs",
    """WITH cells AS (
         SELECT vec_id, label, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
         FROM embeddings),
       centroids AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY 1, 2)
       SELECT vec_id, label,
              round((sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))) + 1) / 2, 6) AS score
       FROM cells JOIN centroids USING (label, i) GROUP BY 1, 2""",
)
def cosine_pairs(spark, folder):
    # Each vector against the mean vector of its class.
    vectors = read_table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")
    )
    means = aggregates.mean_vectors(
        vectors.withColumn("v", array_to_vector("embedding")), ["label"], "v"
    ).select("label", vector_to_array("mean").alias("mean"))
    score = similarity.unit_score(similarity.cosine("embedding", "mean"))
    # There are few classes, so each is frequent.
    paired = spread_join(vectors, materialize(means), "label", "vec_id")
    return paired.select("vec_id", "label", F.round(score, 6).alias("score"))


@query(
    "csv_lines",
    """SELECT concat_ws(',', event_id, user_id, event_type, props->>'$.k') AS line FROM events""",
)
def csv_lines(spark, folder):
    events = read_table(spark, folder, "events")
    line = text.csv_line("event_id", "user_id", "event_type", F.get_json_object("props", "$.k"))
    return events.select(line.alias("line"))


@query(
    "positive_probability",
    """SELECT event_id AS row_id, (floor(value) + 1) / 512 AS positive_probability FROM events""",
)
def positive_probability(spark, folder):
    p = (F.floor("value") + 1) / 512
    printed = F.concat(
        F.lit("["), (1 - p).cast("string"), F.lit(","), p.cast("string"), F.lit("]")
    )
    log = views.scored_interactions(spark, folder).withColumn("probability", printed)
    return log.select("row_id", text.positive_probability("probability").alias("positive_probability"))


@query(
    "submission_projection",
    f"""WITH {INTERACTIONS}
        SELECT tweet_id, engaging_user_id, CASE WHEN score >= 0.1 THEN 1 ELSE 0 END AS prediction
        FROM interactions""",
)
def submission_projection(spark, folder):
    scored = views.scored_interactions(spark, folder)
    return writers.submission(scored.withColumn("prediction", L.at_least("score", 0.1)))


# ---------------------------------------------------------------- joins


@query(
    "encode_ids",
    f"""WITH {INTERACTIONS},
        items AS (SELECT tweet_id, row_number() OVER (ORDER BY tweet_id) - 1 AS tweet_id_index
                  FROM (SELECT DISTINCT tweet_id FROM interactions)),
        users AS (SELECT engaging_user_id, row_number() OVER (ORDER BY engaging_user_id) - 1 AS engaging_user_id_index
                  FROM (SELECT DISTINCT engaging_user_id FROM interactions))
        SELECT row_id, tweet_id_index, engaging_user_id_index, {LABEL_LIST}
        FROM interactions JOIN items USING (tweet_id) JOIN users USING (engaging_user_id)""",
)
def encode_ids(spark, folder):
    log = views.interactions(spark, folder).drop("value")
    indexes = {c: ids.dense_id_index(log, c) for c in (ITEM, USER)}
    return ids.encode_ids(log, indexes)


@query(
    "decode_ids",
    f"""WITH {INTERACTIONS} SELECT row_id, tweet_id, engaging_user_id, score AS prediction FROM interactions""",
)
def decode_ids(spark, folder):
    log = views.scored_interactions(spark, folder).select(
        "row_id", ITEM, USER, F.col("score").alias("prediction")
    )
    indexes = {c: ids.dense_id_index(log, c) for c in (ITEM, USER)}
    return ids.decode_ids(ids.encode_ids(log, indexes), indexes)


@query(
    "remove_deleted",
    f"""WITH {INTERACTIONS}
        SELECT row_id, engaging_user_id, tweet_id FROM interactions
        WHERE engaging_user_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)
          AND tweet_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'de')""",
)
def remove_deleted(spark, folder):
    users = read_table(spark, folder, "customer").filter("c_acctbal < 0")
    items = read_table(spark, folder, "documents").filter("lang = 'de'")
    return cleaning.remove_ids(
        views.interactions(spark, folder).select("row_id", *KEYS),
        users.select(F.col("c_custkey").cast("string").alias(USER)),
        items.select(F.col("doc_id").cast("string").alias(ITEM)),
    )


def _first_sql(id_column: str, n: int) -> str:
    return f"""WITH {INTERACTIONS}
        SELECT row_id, engaging_user_id, tweet_id, {LABEL_LIST} FROM interactions
        WHERE {id_column} IN (SELECT DISTINCT {id_column} FROM interactions ORDER BY {id_column} LIMIT {n})"""


@query("sample_first_users", _first_sql(USER, 10))
def sample_first_users(spark, folder):
    return cleaning.sample_first(views.interactions(spark, folder).drop("value"), USER, 10)


@query("sample_first_items", _first_sql(ITEM, 20))
def sample_first_items(spark, folder):
    return cleaning.sample_first(views.interactions(spark, folder).drop("value"), ITEM, 20)


@query(
    "filter_semi_cohort",
    f"""WITH {INTERACTIONS}
        SELECT row_id, engaging_user_id, tweet_id FROM interactions
        WHERE engaging_user_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def filter_semi_cohort(spark, folder):
    cohort = read_table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    return cleaning.keep_ids(
        views.interactions(spark, folder).select("row_id", *KEYS),
        cohort.select(F.col("c_custkey").cast("string").alias(USER)),
    )


@query(
    "join_predictions",
    f"""WITH {oracle.MODEL_SCORES}
        SELECT engaging_user_id, tweet_id, round(mf, 9) AS mf, round(rf, 9) AS rf, round(nncf, 9) AS nncf
        FROM mf JOIN rf USING (engaging_user_id, tweet_id) JOIN nncf USING (engaging_user_id, tweet_id)""",
)
def join_predictions_query(spark, folder):
    joined = join_predictions(views.model_scores(spark, folder), KEYS)
    return joined.select(*KEYS, *[F.round(m, 9).alias(m) for m in ("mf", "rf", "nncf")])


@query(
    "join_labels",
    f"""WITH {oracle.MODEL_SCORES}, {INTERACTIONS},
        pair_labels AS (SELECT engaging_user_id, tweet_id, max("like") AS label FROM interactions GROUP BY 1, 2)
        SELECT engaging_user_id, tweet_id, round(mf, 9) AS mf, round(nncf, 9) AS nncf, label
        FROM mf JOIN nncf USING (engaging_user_id, tweet_id) JOIN pair_labels USING (engaging_user_id, tweet_id)""",
)
def join_labels_query(spark, folder):
    scores = views.model_scores(spark, folder)
    predictions = join_predictions({m: scores[m] for m in ("mf", "nncf")}, KEYS)
    labels = views.interactions(spark, folder).groupBy(*KEYS).agg(F.max("like").alias("label"))
    joined = join_labels(predictions, labels, KEYS)
    return joined.select(*KEYS, F.round("mf", 9).alias("mf"), F.round("nncf", 9).alias("nncf"), "label")


@query(
    "join_colocated",
    f"""WITH {oracle.MODEL_SCORES}, {INTERACTIONS},
        pair_labels AS (SELECT engaging_user_id, tweet_id, {", ".join(f'max("{e}")::TINYINT AS "{e}"' for e in LABELS)}
                        FROM interactions GROUP BY 1, 2)
        SELECT engaging_user_id, tweet_id, round(mf, 9) AS mf, round(rf, 9) AS rf, round(nncf, 9) AS nncf,
               {", ".join(f'"{e}"' for e in LABELS)}
        FROM mf JOIN rf USING (engaging_user_id, tweet_id) JOIN nncf USING (engaging_user_id, tweet_id)
        JOIN pair_labels USING (engaging_user_id, tweet_id)""",
)
def join_colocated(spark, folder):
    """Predictions and labels written in buckets of (user, item) and joined without an exchange."""
    log = views.interactions(spark, folder, "tinyint")
    buckets = colocated.buckets_for(log.count(), least=4)
    predictions = colocated.write_predictions(views.model_scores(spark, folder), KEYS, buckets)
    labels = colocated.write_labels(log, KEYS, LABELS, buckets)
    return colocated.joined(predictions, labels).select(
        *KEYS, *[F.round(m, 9).alias(m) for m in ("mf", "rf", "nncf")], *LABELS
    )


@query(
    "zip_by_row_number",
    """WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS row_index FROM customer),
            o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_index
                  FROM orders)
       SELECT row_index, c_custkey, o_orderkey FROM c JOIN o USING (row_index)""",
)
def zip_by_row_number(spark, folder):
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    zipped = ordering.zip_by_row_number(
        customers, orders, ["c_acctbal", "c_custkey"], [F.desc("o_totalprice"), "o_orderkey"]
    )
    return zipped.select("row_index", "c_custkey", "o_orderkey")


# ---------------------------------------------------------------- cold start

# Train holds the pairs of urgent orders; some customers and parts occur in the other orders only.
_COLD = """
pairs AS (SELECT o_custkey AS engaging_user_id_index, l_partkey AS tweet_id_index, o_orderpriority
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
train AS (SELECT DISTINCT engaging_user_id_index, tweet_id_index FROM pairs WHERE o_orderpriority = '1-URGENT'),
test AS (SELECT DISTINCT engaging_user_id_index, tweet_id_index FROM pairs WHERE o_orderpriority <> '1-URGENT'),
items AS (SELECT tweet_id_index, row_number() OVER (ORDER BY tweet_id_index) - 1 AS i
          FROM (SELECT tweet_id_index FROM test EXCEPT SELECT tweet_id_index FROM train)),
users AS (SELECT engaging_user_id_index, row_number() OVER (ORDER BY engaging_user_id_index) - 1 AS i
          FROM (SELECT engaging_user_id_index FROM test EXCEPT SELECT engaging_user_id_index FROM train))"""
_ZERO = """CAST(0 AS TINYINT) AS "like", CAST(0 AS TINYINT) AS reply, CAST(0 AS TINYINT) AS retweet,
           CAST(0 AS TINYINT) AS retweet_with_comment"""
_ITEM_IX, _USER_IX = "tweet_id_index", "engaging_user_id_index"


def _cold_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    pairs = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias(_USER_IX),
        F.col("l_partkey").alias(_ITEM_IX),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    # The fill looks at the ids of both parts several times, so the pairs are written once.
    pairs = materialize(pairs.distinct())
    zero = [F.lit(0).cast("tinyint").alias(e) for e in LABELS]
    return tuple(
        pairs.filter(part).select(_ITEM_IX, _USER_IX, *zero)
        for part in (F.col("urgent"), ~F.col("urgent"))
    )


@query(
    "cold_start_missing_ids",
    f"""WITH {_COLD}
        SELECT 'item' AS side, tweet_id_index AS id FROM items
        UNION ALL SELECT 'user', engaging_user_id_index FROM users""",
)
def cold_start_missing_ids(spark, folder):
    train, test = _cold_split(spark, folder)
    items = missing_ids(train, test, _ITEM_IX).select(F.lit("item").alias("side"), F.col(_ITEM_IX).alias("id"))
    users = missing_ids(train, test, _USER_IX).select(F.lit("user").alias("side"), F.col(_USER_IX).alias("id"))
    return items.unionByName(users)


@query(
    "cold_start_fill_zip",
    f"""WITH {_COLD},
        sizes AS (SELECT (SELECT count(*) FROM items) AS ni, (SELECT count(*) FROM users) AS nu),
        slots AS (SELECT unnest(range(greatest(ni, nu))) AS slot, ni, nu FROM sizes),
        fill AS (
          SELECT coalesce(items.tweet_id_index, (SELECT min(tweet_id_index) FROM train)) AS tweet_id_index,
                 coalesce(users.engaging_user_id_index, (SELECT min(engaging_user_id_index) FROM train))
                   AS engaging_user_id_index
          FROM slots LEFT JOIN items ON items.i = slot % ni LEFT JOIN users ON users.i = slot % nu)
        SELECT tweet_id_index, engaging_user_id_index, {_ZERO} FROM fill
        UNION ALL SELECT tweet_id_index, engaging_user_id_index, {_ZERO} FROM train""",
)
def cold_start_fill_zip(spark, folder):
    train, test = _cold_split(spark, folder)
    return full_train(train, zipped_fill(train, test, _ITEM_IX, _USER_IX))


@query(
    "cold_start_fill_partnered",
    f"""WITH {_COLD},
        known_items AS (SELECT tweet_id_index, row_number() OVER (ORDER BY tweet_id_index) - 1 AS i
                        FROM (SELECT DISTINCT tweet_id_index FROM train)),
        known_users AS (SELECT engaging_user_id_index, row_number() OVER (ORDER BY engaging_user_id_index) - 1 AS i
                        FROM (SELECT DISTINCT engaging_user_id_index FROM train)),
        fill AS (
          SELECT m.tweet_id_index, k.engaging_user_id_index FROM items m
          JOIN known_users k ON k.i = m.i % (SELECT count(*) FROM known_users)
          UNION ALL SELECT k.tweet_id_index, m.engaging_user_id_index FROM users m
          JOIN known_items k ON k.i = m.i % (SELECT count(*) FROM known_items))
        SELECT tweet_id_index, engaging_user_id_index, {_ZERO} FROM fill""",
)
def cold_start_fill_partnered(spark, folder):
    train, test = _cold_split(spark, folder)
    return partnered_fill(train, test, _ITEM_IX, _USER_IX)


# ---------------------------------------------------------------- aggregations


@query(
    "distinct_ids",
    f"WITH {INTERACTIONS} SELECT DISTINCT engaging_user_id FROM interactions",
)
def distinct_ids(spark, folder):
    return views.interactions(spark, folder).select(USER).distinct()


@query(
    "distinct_pairs",
    f"WITH {INTERACTIONS} SELECT DISTINCT engaging_user_id, tweet_id FROM interactions",
)
def distinct_pairs(spark, folder):
    return views.interactions(spark, folder).select(*KEYS).dropDuplicates(KEYS)


@query(
    "count_distinct_users",
    f"WITH {INTERACTIONS} SELECT count(DISTINCT engaging_user_id) AS users FROM interactions",
)
def count_distinct_users(spark, folder):
    # Distinct first, so that no single task sees all users.
    return views.interactions(spark, folder).select(USER).distinct().agg(F.count(USER).alias("users"))


@query(
    "row_counts",
    f"""WITH {INTERACTIONS}
        SELECT count(*) AS n, CAST(sum("like") AS BIGINT) AS "like", CAST(sum(reply) AS BIGINT) AS reply,
               CAST(sum(retweet) AS BIGINT) AS retweet,
               CAST(sum(retweet_with_comment) AS BIGINT) AS retweet_with_comment
        FROM interactions""",
)
def row_counts(spark, folder):
    return views.interactions(spark, folder).agg(
        F.count("*").alias("n"), *[F.sum(e).alias(e) for e in LABELS]
    )


@query(
    "label_base_rates",
    f"""WITH {INTERACTIONS}, {oracle.LONG_LABELS}
        SELECT label, round(avg(y), 9) AS base_rate FROM long_labels GROUP BY 1""",
)
def label_base_rates(spark, folder):
    rates = views.interactions(spark, folder).agg(*[F.avg(e).alias(e) for e in LABELS])
    rows = [F.struct(F.lit(e).alias("label"), F.round(F.col(e), 9).alias("base_rate")) for e in LABELS]
    return rates.select(F.inline(F.array(*rows)))


@query(
    "minmax_scores",
    """SELECT event_id AS row_id,
              round((value - (SELECT min(value) FROM events))
                    / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 9) AS normalized
       FROM events""",
)
def minmax_scores(spark, folder):
    scored = views.interactions(spark, folder).select("row_id", F.col("value").alias("normalized"))
    bounds = aggregates.minmax_bounds(scored, ["normalized"])
    scaled = aggregates.minmax_scale(scored, ["normalized"], bounds)
    return scaled.select("row_id", F.round("normalized", 9).alias("normalized"))


@query(
    "score_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
       SELECT CAST(least(floor((value - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n
       FROM events, b GROUP BY 1""",
)
def score_histogram(spark, folder):
    return aggregates.histogram(views.interactions(spark, folder), "value", 50).select("bin", "n")


@query(
    "token_length_stats",
    f"""WITH {oracle.TERMS}
        SELECT CAST(max(len(tokens)) AS INTEGER) AS longest, round(avg(len(tokens)), 6) AS mean,
               count(*) AS documents FROM tokenized""",
)
def token_length_stats(spark, folder):
    lengths = read_table(spark, folder, "documents").select(
        F.size(text.tokens("text", text.WHITESPACE)).alias("n")
    )
    return lengths.agg(
        F.max("n").alias("longest"), F.round(F.avg("n"), 6).alias("mean"), F.count("*").alias("documents")
    )


@query(
    "token_length_histogram",
    f"""WITH {oracle.TERMS},
        lengths AS (SELECT len(tokens)::DOUBLE AS x FROM tokenized),
        b AS (SELECT min(x) AS lo, max(x) AS hi FROM lengths)
        SELECT CAST(least(floor((x - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, count(*) AS n
        FROM lengths, b GROUP BY 1""",
)
def token_length_histogram(spark, folder):
    lengths = read_table(spark, folder, "documents").select(
        F.size(text.tokens("text", text.WHITESPACE)).alias("n_tokens")
    )
    # The texts are tokenised once, for the bounds and for the bins.
    return aggregates.histogram(materialize(lengths), "n_tokens", 10).select("bin", "n")


# ---------------------------------------------------------------- numbering, limits, sets


@query(
    "dense_id_index",
    f"""WITH {INTERACTIONS}
        SELECT engaging_user_id, row_number() OVER (ORDER BY engaging_user_id) - 1 AS engaging_user_id_index
        FROM (SELECT DISTINCT engaging_user_id FROM interactions)""",
)
def dense_id_index(spark, folder):
    return ids.dense_id_index(views.interactions(spark, folder), USER)


@query(
    "extended_id_index",
    f"""WITH {INTERACTIONS},
        old AS (SELECT engaging_user_id, count(*) AS n FROM interactions WHERE row_id % 3 = 0 GROUP BY 1),
        new AS (SELECT engaging_user_id, count(*) AS n FROM interactions WHERE row_id % 3 <> 0 GROUP BY 1)
        SELECT engaging_user_id, old.n + coalesce(new.n, 0) AS n,
               row_number() OVER (ORDER BY engaging_user_id) - 1 AS engaging_user_id_index
        FROM old LEFT JOIN new USING (engaging_user_id)
        UNION ALL
        SELECT engaging_user_id, new.n,
               (SELECT count(*) FROM old) + row_number() OVER (ORDER BY engaging_user_id) - 1
        FROM new ANTI JOIN old USING (engaging_user_id)""",
)
def extended_id_index(spark, folder):
    """An index of a first batch of impressions, written, read and extended by a second batch."""
    log = views.interactions(spark, folder)
    first = materialize(ids.dense_id_index(log.filter("row_id % 3 = 0"), USER, counted=True))
    return ids.extend_id_index(first, log.filter("row_id % 3 <> 0"), USER)


@query(
    "topk_items_by_score",
    f"""WITH {INTERACTIONS},
        pairs AS (SELECT engaging_user_id, tweet_id, max(score) AS score FROM interactions GROUP BY 1, 2)
        SELECT engaging_user_id, tweet_id, score, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY engaging_user_id ORDER BY score DESC, tweet_id) AS rank FROM pairs)
        WHERE rank <= 10""",
)
def topk_items_by_score(spark, folder):
    pairs = views.scored_interactions(spark, folder).groupBy(*KEYS).agg(F.max("score").alias("score"))
    return ordering.top_k(pairs, USER, [F.desc("score"), F.col(ITEM)], 10)


@query(
    "ordered_rows",
    f"WITH {INTERACTIONS} SELECT row_id, tweet_id, score FROM interactions ORDER BY score DESC, row_id",
)
def ordered_rows(spark, folder):
    scored = views.scored_interactions(spark, folder).select("row_id", ITEM, "score")
    return scored.orderBy(F.desc("score"), "row_id")


@query(
    "union_by_name",
    f"""WITH {INTERACTIONS}
        SELECT engaging_user_id, tweet_id, "like" FROM interactions
        UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 0 FROM orders""",
)
def union_by_name(spark, folder):
    log = views.interactions(spark, folder).select(*KEYS, "like")
    bought = read_table(spark, folder, "orders").select(
        F.lit(0).alias("like"),
        F.col("o_orderkey").cast("string").alias(ITEM),
        F.col("o_custkey").cast("string").alias(USER),
    )
    return log.unionByName(bought)
