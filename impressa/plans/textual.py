"""Term weights, category encodings, scaling, and relevance feedback profiles."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.functions import text
from impressa.functions.numbers import rounded
from impressa.operators import aggregates, encoding, profiles, sampling, textweights
from impressa.plans import oracle
from impressa.plans.registry import query
from impressa.session import materialize
from impressa.sources import views
from impressa.sources.readers import read_table
from impressa.sources.schemas import CATEGORY_COLUMNS, ITEM, KEYS, LABELS, NUMERIC_COLUMNS, USER

TERMS = oracle.TERMS


def _document_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return textweights.term_counts(documents, "doc_id", text.tokens("text", text.WHITESPACE))


@query("term_counts", f"WITH {TERMS} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, folder):
    return _document_counts(spark, folder)


@query(
    "hashing_tf",
    f"""WITH {TERMS}
        SELECT doc_id, CAST({oracle.key_hash(0, 'term')} % 1024 AS INTEGER) AS bucket, CAST(sum(tf) AS BIGINT) AS tf
        FROM counts GROUP BY 1, 2""",
)
def hashing_tf(spark, folder):
    return textweights.hashed_counts(_document_counts(spark, folder), "doc_id", 1024)


@query("hashing_tf_ml")
def hashing_tf_ml(spark, folder):
    """The hash of the ML library, as (doc, bucket, tf)."""
    documents = read_table(spark, folder, "documents").select(
        "doc_id", text.tokens("text", text.WHITESPACE).alias("tokens")
    )
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1 << 10).transform(documents)
    sparse = hashed.select("doc_id", F.unwrap_udt("tf").alias("v"))
    cells = sparse.select("doc_id", F.explode(F.arrays_zip("v.indices", "v.values")).alias("c"))
    return cells.select("doc_id", F.col("c.indices").alias("bucket"), F.col("c.values").alias("tf"))


_VOCABULARY = f"""{TERMS},
vocabulary AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf,
                      row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS term_index
               FROM counts GROUP BY 1)"""


@query("idf", f"WITH {_VOCABULARY} SELECT term, term_index, df, round(idf, 9) AS idf FROM vocabulary")
def idf(spark, folder):
    documents = read_table(spark, folder, "documents")
    vocabulary = textweights.fit_vocabulary(_document_counts(spark, folder), documents, "doc_id")
    return vocabulary.withColumn("idf", F.round("idf", 9))


@query(
    "tfidf_normalized",
    f"""WITH {_VOCABULARY},
        weighted AS (SELECT doc_id, term_index, tf * idf AS w FROM counts JOIN vocabulary USING (term)),
        lengths AS (SELECT doc_id, sqrt(sum(w * w)) AS length FROM weighted GROUP BY 1)
        SELECT doc_id, term_index, round(coalesce(w / nullif(length, 0), 0), 6) AS weight
        FROM weighted JOIN lengths USING (doc_id)""",
)
def tfidf_normalized(spark, folder):
    documents = read_table(spark, folder, "documents")
    # Whole texts come together by document, once for each use; all that follows stays where they are.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = documents.select("doc_id", "text").repartition(tasks, "doc_id")
    counts = textweights.term_counts(laid_out, "doc_id", text.tokens("text", text.WHITESPACE))
    vocabulary = textweights.fit_vocabulary(counts, documents, "doc_id")
    weighted = textweights.weighted_terms(counts, vocabulary, "doc_id", tasks)
    vectors = textweights.document_vectors(weighted, "doc_id")
    cells = vectors.select("doc_id", F.inline("terms"))
    return cells.withColumn("weight", rounded("weight", 6))


# ---------------------------------------------------------------- categories and numbers


def _category_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", {column} AS value, count(*) AS n,
                      row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS index
               FROM prepared WHERE part = 'train' GROUP BY {column}"""


# Encodings are fitted on one part of the rows and applied to all.
PREPARED_CATEGORIES = f"""{oracle.IMPRESSIONS},
prepared AS (
  SELECT row_id, tweet_type, language, coalesce(present_media, 'none') AS present_media,
         CASE WHEN {oracle.key_hash(42, 'row_id')} < {oracle.bound(0.9)} THEN 'train' ELSE 'test' END AS part
  FROM impressions),
indexes AS ({' UNION ALL '.join(_category_sql(c) for c in CATEGORY_COLUMNS)})"""


def _prepared(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All rows, and those that encodings are fitted on."""
    log = views.impressions(spark, folder).select("row_id", *CATEGORY_COLUMNS, *NUMERIC_COLUMNS)
    log = log.fillna("none", subset=["present_media"])
    return log, log.filter(sampling.in_fraction(0.9, 42, "row_id"))


@query(
    "category_index",
    f"""WITH {PREPARED_CATEGORIES} SELECT value, n, index FROM indexes WHERE "column" = 'tweet_type'""",
)
def category_index(spark, folder):
    _, train = _prepared(spark, folder)
    return encoding.category_index(train, "tweet_type")


@query("explain_encoding", f"""WITH {PREPARED_CATEGORIES} SELECT "column", value, n, index FROM indexes""")
def explain_encoding(spark, folder):
    _, train = _prepared(spark, folder)
    return encoding.category_indexes(train, CATEGORY_COLUMNS)


@query(
    "one_hot",
    f"""WITH {PREPARED_CATEGORIES},
        cells AS ({' UNION ALL '.join(
            f"""SELECT row_id, '{c}' AS "column", {c} AS value FROM prepared""" for c in CATEGORY_COLUMNS)})
        SELECT cells.row_id, cells."column", indexes.index, 1.0::DOUBLE AS value
        FROM cells JOIN indexes ON cells."column" = indexes."column" AND cells.value = indexes.value""",
)
def one_hot(spark, folder):
    log, train = _prepared(spark, folder)
    indexes = encoding.category_indexes(train, CATEGORY_COLUMNS)
    return encoding.one_hot_entries(log, "row_id", CATEGORY_COLUMNS, indexes)


def _scaled_sql(column: str) -> str:
    low, high = (f"(SELECT {f}({column}) FROM train)" for f in ("min", "max"))
    return f"round(coalesce(({column} - {low}) / nullif({high} - {low}, 0)::DOUBLE, 0.5), 9) AS {column}"


@query(
    "minmax_scale",
    f"""WITH {oracle.IMPRESSIONS},
        train AS (SELECT * FROM impressions WHERE {oracle.key_hash(42, 'row_id')} < {oracle.bound(0.9)})
        SELECT row_id, {', '.join(_scaled_sql(c) for c in NUMERIC_COLUMNS)} FROM impressions""",
)
def minmax_scale(spark, folder):
    log, train = _prepared(spark, folder)
    bounds = aggregates.minmax_bounds(train, NUMERIC_COLUMNS)
    scaled = aggregates.minmax_scale(log, NUMERIC_COLUMNS, materialize(bounds))
    return scaled.select("row_id", *[F.round(c, 9).alias(c) for c in NUMERIC_COLUMNS])


# ---------------------------------------------------------------- relevance feedback

_FEEDBACK = rf"""{oracle.INTERACTIONS},
train AS (SELECT * FROM interactions WHERE {oracle.key_hash(42, 'row_id')} < {oracle.bound(0.9)}),
test AS (SELECT DISTINCT engaging_user_id, tweet_id FROM interactions
         WHERE NOT {oracle.key_hash(42, 'row_id')} < {oracle.bound(0.9)}),
tokenized AS (
  SELECT CAST(doc_id AS VARCHAR) AS tweet_id,
         unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')) AS term
  FROM documents WHERE CAST(doc_id AS VARCHAR) IN (SELECT tweet_id FROM interactions)),
counts AS (SELECT tweet_id, term, count(*) AS tf FROM tokenized GROUP BY 1, 2),
shown AS (SELECT tweet_id, count(*) AS w FROM train GROUP BY 1),
vocabulary AS (
  SELECT term, row_number() OVER (ORDER BY sum(tf * w) DESC, term) - 1 AS term_index,
         ln(((SELECT count(*) FROM train) + 1) / (sum(w) + 1)) AS idf
  FROM counts JOIN shown USING (tweet_id) GROUP BY 1),
weighted AS (SELECT tweet_id, term_index, tf * idf AS w FROM counts JOIN vocabulary USING (term)),
lengths AS (SELECT tweet_id, sqrt(sum(w * w)) AS length FROM weighted GROUP BY 1),
vectors AS (SELECT tweet_id, term_index, coalesce(w / nullif(length, 0), 0) AS weight
            FROM weighted JOIN lengths USING (tweet_id)),
pairs AS (SELECT engaging_user_id, tweet_id, count(*) AS n, sum("like") AS n_like, sum(reply) AS n_reply,
                 sum(retweet) AS n_retweet, sum(retweet_with_comment) AS n_retweet_with_comment
          FROM train GROUP BY 1, 2),
sizes AS (SELECT engaging_user_id, sum(n) AS n, sum(n_like) AS n_like, sum(n_reply) AS n_reply,
                 sum(n_retweet) AS n_retweet, sum(n_retweet_with_comment) AS n_retweet_with_comment
          FROM pairs GROUP BY 1),
sums AS (SELECT engaging_user_id, term_index, {', '.join(
    f"sum(n_{e} * weight) AS pos_{e}, sum((n - n_{e}) * weight) AS neg_{e}" for e in LABELS)}
         FROM pairs JOIN vectors USING (tweet_id) GROUP BY 1, 2),
means AS (SELECT engaging_user_id, term_index, {', '.join(
    f"coalesce(pos_{e} / nullif(n_{e}, 0), 0) AS pos_{e}, coalesce(neg_{e} / nullif(n - n_{e}, 0), 0) AS neg_{e}"
    for e in LABELS)}
          FROM sums JOIN sizes USING (engaging_user_id)),
profiles AS (SELECT engaging_user_id, term_index, {', '.join(f'pos_{e} - neg_{e} AS "{e}"' for e in LABELS)}
             FROM means)"""


def _feedback(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train pairs, test pairs, item vectors); text weights are fitted on train impressions."""
    log = views.interactions(spark, folder)
    train, test = sampling.split(log, 0.9, 42, "row_id")
    shown = train.groupBy(ITEM).agg(F.count("*").alias("shown"))
    seen = log.select(ITEM).distinct()
    texts = views.item_texts(spark, folder).join(seen, ITEM, "left_semi")
    counts = materialize(textweights.term_counts(texts, ITEM, text.tokens("text", text.WHITESPACE)))
    vocabulary = textweights.fit_vocabulary(counts, shown, ITEM, weight="shown")
    weighted = textweights.weighted_terms(counts, vocabulary, ITEM)
    vectors = materialize(textweights.document_vectors(weighted, ITEM))
    pairs = materialize(profiles.pair_counts(train))
    return pairs, materialize(test.select(*KEYS).distinct()), vectors


@query(
    "class_mean_vectors",
    f"""WITH {_FEEDBACK}
        SELECT engaging_user_id, term_index, {', '.join(
            f"round(pos_{e}, 6) AS pos_{e}, round(neg_{e}, 6) AS neg_{e}" for e in LABELS)} FROM means""",
)
def class_mean_vectors(spark, folder):
    pairs, _, vectors = _feedback(spark, folder)
    means = profiles.class_means(pairs, vectors)
    return means.select(
        USER, "term_index", *[rounded(f"{s}_{e}", 6).alias(f"{s}_{e}") for e in LABELS for s in ("pos", "neg")]
    )


@query(
    "rocchio_profiles",
    f"""WITH {_FEEDBACK}
        SELECT engaging_user_id, term_index, {', '.join(f'round("{e}", 6) + 0.0::DOUBLE AS "{e}"' for e in LABELS)}
        FROM profiles""",
)
def rocchio_profiles(spark, folder):
    pairs, _, vectors = _feedback(spark, folder)
    built = profiles.profiles(pairs, vectors)
    return built.select(USER, "term_index", *[rounded(e, 6).alias(e) for e in LABELS])


@query(
    "rocchio_scores",
    f"""WITH {_FEEDBACK},
        norms AS (SELECT engaging_user_id, {', '.join(f'sqrt(sum("{e}" * "{e}")) AS norm_{e}' for e in LABELS)}
                  FROM profiles GROUP BY 1),
        dots AS (SELECT t.engaging_user_id, t.tweet_id, sqrt(sum(v.weight * v.weight)) AS norm, {', '.join(
            f'sum(v.weight * coalesce(p."{e}", 0)) AS dot_{e}' for e in LABELS)}
                 FROM test t JOIN vectors v ON v.tweet_id = t.tweet_id
                 LEFT JOIN profiles p ON p.engaging_user_id = t.engaging_user_id AND p.term_index = v.term_index
                 GROUP BY 1, 2)
        SELECT engaging_user_id, tweet_id, {', '.join(
            f'round((dot_{e} / nullif(norm * norm_{e}, 0) + 1) / 2, 6) AS "{e}"' for e in LABELS)}
        FROM dots JOIN norms USING (engaging_user_id)""",
)
def rocchio_scores(spark, folder):
    pairs, test, vectors = _feedback(spark, folder)
    built = profiles.profiles(pairs, vectors, unfolded=False)
    scores = profiles.profile_scores(test, vectors, built)
    return scores.select(*KEYS, *[F.round(e, 6).alias(e) for e in LABELS])
