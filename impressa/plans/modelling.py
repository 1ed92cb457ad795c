"""Feature vectors, fitted models, their scores and result tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.models import features, grid, hashed, jobs, recommend, stacking
from impressa.models.recommend import ITEM_INDEX, USER_INDEX
from impressa.models.retrieval import best_by_factors
from impressa.operators import evaluation, ids, sampling
from impressa.operators.joins import join_predictions
from impressa.plans import oracle
from impressa.plans.registry import query
from impressa.plans.scoring import ENSEMBLE_THRESHOLDS, GRID_THRESHOLDS
from impressa.plans.textual import PREPARED_CATEGORIES
from impressa.session import materialize
from impressa.sources import views, writers
from impressa.sources.schemas import BOOLEAN_COLUMNS, ITEM, KEYS, LABELS, NUMERIC_COLUMNS, USER

_BUCKETS = (features.HASHTAG_BUCKETS, features.TEXT_BUCKETS)
# Forests read the whole text, too. (The 8 and 12 of earlier ones were 2^10 and 2^14, taken for an exclusive or.)
_FOREST_BUCKETS = _BUCKETS

# ---------------------------------------------------------------- feature vectors


def _even_files(spark: SparkSession) -> int:
    """Files of rows that many passes read: two a core.

    A pass packs files into tasks of a core's share, up to a fixed size that counts each file's opening. 200 small
    files make 7 tasks on 6 cores, the last alone in every pass; two a core make one task a core, or two if large.
    """
    return 2 * spark.sparkContext.defaultParallelism


def _prepared(
    spark: SparkSession, folder: str, buckets: tuple[int, int] = _BUCKETS, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows ready for the feature stages.

    What is written once for the passes of the fits is the narrow part, rows with their reader, and the
    hashed items. Rows grow a lot when the term counts of the item come in, so they are dealt out evenly
    to an explicit number of tasks before that, and joined with their items by each pass. Where ``whole``
    vectors are taken once by long passes, rows lie in even files, those of an item side by side.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shown = views.exposures(spark, folder)
    # Written out, the hashed items have a known size, and each text is hashed once.
    seen = views.item_attributes(spark, folder).join(shown.select(ITEM).distinct(), ITEM, "left_semi")
    items = materialize(features.hash_items(seen, *buckets))
    users = views.user_attributes(spark, folder)
    with_readers = views.attach_readers(shown, users)
    if whole:
        files = _even_files(spark)
        dealt = with_readers.repartition(-(-tasks // files) * files, "row_id").coalesce(files)
        narrow = materialize(dealt.sortWithinPartitions(ITEM, "row_id"))
    else:
        narrow = materialize(with_readers.repartition(tasks, "row_id"))
    prepared = features.prepare_hashed(views.attach_items(narrow, items), keep=("row_id",))
    return sampling.split(prepared, 0.9, 42, "row_id")


def _plain(vectors: DataFrame) -> DataFrame:
    """The vector as a struct (type, size, indices, values)."""
    return vectors.withColumn(features.VECTOR, F.unwrap_udt(features.VECTOR))


_ASSEMBLED = [*BOOLEAN_COLUMNS, *NUMERIC_COLUMNS]


@query(
    "assemble_features",
    f"""WITH {oracle.IMPRESSIONS},
        train AS (SELECT *, row_id % 2 = 0 AS engaged_follows_engaging FROM impressions
                  WHERE {oracle.key_hash(42, 'row_id')} < {oracle.bound(0.9)})
        SELECT row_id, tweet_id, engaging_user_id, unnest(range({len(_ASSEMBLED)}))::INTEGER AS slot,
               unnest([{', '.join(f'{c}::DOUBLE' for c in _ASSEMBLED)}]) AS value FROM train""",
)
def assemble_features(spark, folder):
    """Flags and numbers as one vector, in table order, a row per slot."""
    log = views.impressions(spark, folder).select("row_id", *KEYS, *_ASSEMBLED)
    train, _ = sampling.split(log, 0.9, 42, "row_id")
    inputs = features.feature_columns(train, (*KEYS, "row_id"))
    assembled = VectorAssembler(inputCols=inputs, outputCol=features.VECTOR).transform(train)
    values = F.posexplode(vector_to_array(features.VECTOR)).alias("slot", "value")
    return assembled.select("row_id", *KEYS, values)


@query("feature_vectors_train")
def feature_vectors_train(spark, folder):
    train, _ = _prepared(spark, folder)
    model = features.fit_features(train, hashed=True)
    return _plain(features.features(model, train, keep=("row_id",)))


@query("feature_vectors_test")
def feature_vectors_test(spark, folder):
    train, test = _prepared(spark, folder)
    model = features.fit_features(train, hashed=True)
    return _plain(features.features(model, test, keep=("row_id",)))


@query(
    "explain_encoding_ml",
    f"""WITH {PREPARED_CATEGORIES}
        SELECT "column", index::DOUBLE AS index,
               CASE "column" WHEN 'present_media' THEN '[' || replace(lower(value), chr(9), ', ') || ']'
                             ELSE value END AS value,
               '(' || count(*) OVER (PARTITION BY "column") || ',[' || index || '],[1.0])' AS onehot
        FROM indexes""",
)
def explain_encoding_ml(spark, folder):
    train, _ = _prepared(spark, folder, _FOREST_BUCKETS)
    return features.encoding_table(features.fit_features(train, hashed=True), train)


def _forest_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Feature vectors of both parts.

    Those of the train part are made where they are read: fits write them in a form of their own. Those of
    the other part are written once for the four labels.
    """
    train, test = _prepared(spark, folder, _FOREST_BUCKETS, whole=True)
    model = features.fit_features(train, hashed=True)
    train, test = (features.features(model, part, keep=("row_id",)) for part in (train, test))
    return train, materialize(test)


@query("rf_predict")
def rf_predict(spark, folder):
    """One held-out part, all labels."""
    train, test = _forest_rows(spark, folder)
    return jobs.forest_job(train, test)


def _held_out(rows: DataFrame) -> dict[str, DataFrame]:
    """The held-out rows in two parts: for fitting an ensemble, and for judging it."""
    first, second = sampling.split(rows, 0.5, 43, "row_id")
    return {"ensemble_train": first, "test": second}


@query("rf_job")
def rf_job(spark, folder):
    """Both held-out parts, all labels."""
    train, test = _forest_rows(spark, folder)
    return jobs.forest_job(train, _held_out(test))


@query("rf_grid_search")
def rf_grid_search(spark, folder):
    """The whole grid in all folds: a row per label and setting."""
    train, _ = _forest_rows(spark, folder)
    results, _ = jobs.tuned_forest_job(train, {}, ["row_id"])
    return results


@query("rf_tuned_job")
def rf_tuned_job(spark, folder):
    """Both held-out parts, all labels, by the best forest of the whole grid."""
    train, test = _forest_rows(spark, folder)
    _, predictions = jobs.tuned_forest_job(train, _held_out(test), ["row_id"])
    return predictions


# ---------------------------------------------------------------- factorisation


def _indexed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """(train, test, id indexes) of the interactions."""
    log = views.interactions(spark, folder).drop("value")
    indexes = {c: materialize(ids.dense_id_index(log, c, counted=True)) for c in (ITEM, USER)}
    indexed = materialize(ids.encode_ids(log, indexes))
    train, test = sampling.split(indexed, 0.9, 42, "row_id")
    return train, test, indexes


@query(
    "mf_split_job",
    f"""WITH {oracle.INTERACTIONS},
        items AS (SELECT tweet_id, row_number() OVER (ORDER BY tweet_id) - 1 AS tweet_id_index
                  FROM (SELECT DISTINCT tweet_id FROM interactions)),
        users AS (SELECT engaging_user_id, row_number() OVER (ORDER BY engaging_user_id) - 1 AS engaging_user_id_index
                  FROM (SELECT DISTINCT engaging_user_id FROM interactions)),
        indexed AS (
          SELECT *, row_number() OVER (ORDER BY {oracle.key_hash(42, 'row_id')}, row_id) <= 1000 AS held_out
          FROM interactions JOIN items USING (tweet_id) JOIN users USING (engaging_user_id)),
        train AS (SELECT * FROM indexed WHERE NOT held_out), test AS (SELECT * FROM indexed WHERE held_out),
        new_items AS (SELECT tweet_id_index, row_number() OVER (ORDER BY tweet_id_index) - 1 AS i
                      FROM (SELECT tweet_id_index FROM test EXCEPT SELECT tweet_id_index FROM train)),
        new_users AS (SELECT engaging_user_id_index, row_number() OVER (ORDER BY engaging_user_id_index) - 1 AS i
                      FROM (SELECT engaging_user_id_index FROM test EXCEPT SELECT engaging_user_id_index FROM train)),
        sizes AS (SELECT (SELECT count(*) FROM new_items) AS ni, (SELECT count(*) FROM new_users) AS nu),
        slots AS (SELECT unnest(range(greatest(ni, nu))) AS slot, ni, nu FROM sizes),
        fill AS (
          SELECT coalesce(n.tweet_id_index, (SELECT min(tweet_id_index) FROM train)) AS tweet_id_index,
                 coalesce(u.engaging_user_id_index, (SELECT min(engaging_user_id_index) FROM train))
                   AS engaging_user_id_index
          FROM slots LEFT JOIN new_items n ON n.i = slot % ni LEFT JOIN new_users u ON u.i = slot % nu)
        SELECT 'test' AS part, tweet_id_index, engaging_user_id_index, CAST("like" AS TINYINT) AS "like",
               CAST(reply AS TINYINT) AS reply, CAST(retweet AS TINYINT) AS retweet,
               CAST(retweet_with_comment AS TINYINT) AS retweet_with_comment FROM test
        UNION ALL SELECT 'train', tweet_id_index, engaging_user_id_index, CAST("like" AS TINYINT),
               CAST(reply AS TINYINT), CAST(retweet AS TINYINT), CAST(retweet_with_comment AS TINYINT) FROM train
        UNION ALL SELECT 'train', tweet_id_index, engaging_user_id_index, 0::TINYINT, 0::TINYINT, 0::TINYINT, 0::TINYINT
               FROM fill""",
)
def mf_split_job(spark, folder):
    log = views.interactions(spark, folder, "tinyint").drop("value")
    train, test, _ = jobs.split_job(log)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("als_predict")
def als_predict(spark, folder):
    train, test, _ = _indexed(spark, folder)
    hot = recommend.frequent_ids(test)
    scored = [
        recommend.score_pairs(recommend.fit_implicit(train, label), test, hot=hot).select(
            "row_id", USER_INDEX, ITEM_INDEX, F.lit(label).alias("engagement"),
            F.col(label).alias("label"), "prediction",
        )
        for label in LABELS
    ]
    return reduce(DataFrame.unionByName, scored)


@query("als_grid_search")
def als_grid_search(spark, folder):
    train, test, _ = _indexed(spark, folder)
    return recommend.grid_search(train, test, GRID_THRESHOLDS)


@query("mf_job")
def mf_job(spark, folder):
    """Both held-out parts, all labels, ids and indexes side by side."""
    train, test, indexes = _indexed(spark, folder)
    parts = {n: rows.select(USER_INDEX, ITEM_INDEX).distinct() for n, rows in _held_out(test).items()}
    return jobs.factorisation_job(train, parts, indexes)


def _explicit(spark: SparkSession, folder: str):
    bought = materialize(views.purchases(spark, folder))
    train, test = sampling.split(bought, 0.8, 42, "user", "item")
    ints = [F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "rating"]
    return train.select(*ints), test.select(*ints)


@query("als_explicit")
def als_explicit(spark, folder):
    train, test = _explicit(spark, folder)
    model = recommend.fit_explicit(train, "user", "item", "rating")
    return recommend.explicit_error(model, test, "user", "item", "rating")


def _topk(spark: SparkSession, folder: str, key: str, subset: bool):
    """The 10 best partners of users or items, of all or of those in the test part."""
    train, test = _explicit(spark, folder)
    model = recommend.fit_explicit(train, "user", "item", "rating")
    sides = {"user": model.userFactors, "item": model.itemFactors}
    other = "item" if key == "user" else "user"
    wanted = sides[key]
    if subset:
        wanted = wanted.join(test.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    found = best_by_factors(wanted, sides[other], 10)
    return found.select(
        F.col("query").cast("int").alias(key), F.col("item").cast("int").alias(other), "score", "rank"
    )


@query("als_topk_users")
def als_topk_users(spark, folder):
    return _topk(spark, folder, "user", subset=False)


@query("als_topk_items")
def als_topk_items(spark, folder):
    return _topk(spark, folder, "item", subset=False)


@query("als_topk_user_subset")
def als_topk_user_subset(spark, folder):
    """Users that bought something in the test part."""
    return _topk(spark, folder, "user", subset=True)


@query("als_topk_item_subset")
def als_topk_item_subset(spark, folder):
    return _topk(spark, folder, "item", subset=True)


@query("neural_cf_predict")
def neural_cf_predict(spark, folder):
    train, test, indexes = _indexed(spark, folder)
    pairs = materialize(ids.decode_ids(test.select(USER_INDEX, ITEM_INDEX).distinct(), indexes, keep_index=True))
    scored = [
        jobs.neural_scores(recommend.fit_implicit(train, label, rank=8), train, pairs, label).select(
            USER, ITEM, F.lit(label).alias("engagement"), "prediction"
        )
        for label in LABELS
    ]
    return reduce(DataFrame.unionByName, scored)


@query("hashed_fm_predict")
def hashed_fm_predict(spark, folder):
    """Factorisation machines on hashed ids: no id index, and ids that training never saw are scored, too."""
    log = views.interactions(spark, folder)
    train, test = sampling.split(log, 0.9, 42, "row_id")
    rows = materialize(hashed.hashed_pairs(train, LABELS))
    pairs = materialize(hashed.hashed_pairs(test.select(*KEYS).distinct()))
    scored = [
        hashed.scores(model, pairs).select(USER, ITEM, F.lit(label).alias("engagement"), "prediction")
        for label, model in hashed.fit_all(rows, LABELS).items()
    ]
    return reduce(DataFrame.unionByName, scored)


# ---------------------------------------------------------------- stacker

_MODELS = ["mf", "rf", "nncf"]
# What the jobs fit: rank and alpha of the factorisation, rank of the factors below the net.
_RANK, _ALPHA, _NET_RANK = 50, 10.0, 8
_UNTUNED = grid.Setting(trees=20, depth=5, min_rows=1)


def _base_scores(
    train: DataFrame, pairs: dict[str, DataFrame], forest, vectors: dict[str, DataFrame], label: str
) -> dict[str, DataFrame]:
    """Scores of the three models of one label on each part, joined with the label."""
    factors = recommend.fit_implicit(train, label, rank=_RANK, alpha=_ALPHA)
    below = recommend.fit_implicit(train, label, rank=_NET_RANK)
    net = jobs.fit_net(below, train, label)
    joined = {}
    for name, wanted in pairs.items():
        named = wanted.select(USER_INDEX, ITEM_INDEX, *KEYS)
        mf = recommend.score_pairs(factors, named)
        nncf = recommend.neural_scores(net, recommend.factor_features(below, named))
        rf = writers.class_predictions(forest.transform(vectors[name]))
        tables = {
            "mf": mf.withColumnRenamed("prediction", "mf"),
            "rf": rf.withColumnRenamed("positive_probability", "rf"),
            "nncf": nncf.withColumnRenamed("prediction", "nncf"),
        }
        labels = wanted.select(*KEYS, F.col(label).alias("label"))
        rows = stacking.stacking_rows(tables, labels).withColumn("engagement", F.lit(label))
        joined[name] = materialize(rows)
    return joined


def _stacking(spark: SparkSession, folder: str, tuned: bool = False) -> dict[str, DataFrame]:
    """Pairs of both held-out parts with the scores of three models fitted on the train part.

    (user, item, engagement, mf, rf, nncf, label), a row per pair and label. The models are those of the
    jobs, the forest with the best setting of the whole grid if ``tuned``. Labels are fitted side by side.
    """
    train, test, indexes = _indexed(spark, folder)
    vectors, held_vectors = _forest_rows(spark, folder)
    vector_parts = _held_out(held_vectors)
    pairs = {
        name: materialize(
            ids.decode_ids(
                part.groupBy(USER_INDEX, ITEM_INDEX).agg(*[F.max(e).alias(e) for e in LABELS]),
                indexes,
                keep_index=True,
            )
        )
        for name, part in _held_out(test).items()
    }
    train = materialize(train)
    settings = dict.fromkeys(LABELS, _UNTUNED)
    if tuned:
        settings = grid.best_settings(grid.search(vectors, LABELS, ["row_id"]))
    forests = jobs.fit_forests(vectors, settings)
    fitted = jobs.side_by_side(
        spark, {e: partial(_base_scores, train, pairs, forests[e], vector_parts, e) for e in LABELS}
    )
    return {name: reduce(DataFrame.unionByName, [fitted[e][name] for e in LABELS]) for name in pairs}


def _of(rows: DataFrame, label: str) -> DataFrame:
    return rows.filter(F.col("engagement") == label)


@query(
    "stacker_single",
    f"""WITH {oracle.MODEL_SCORES}, {oracle.INTERACTIONS},
        labels AS (SELECT engaging_user_id, tweet_id, max("like") AS label FROM interactions GROUP BY 1, 2),
        rows_ AS (SELECT mf, label FROM mf JOIN labels USING (engaging_user_id, tweet_id)),
        scaled AS (SELECT (mf - (SELECT min(mf) FROM rows_)) / ((SELECT max(mf) FROM rows_) - (SELECT min(mf) FROM rows_))
                          AS x, label AS y FROM rows_)
        SELECT round(regr_slope(y, x), 6) AS mf, round(regr_intercept(y, x), 6) AS intercept FROM scaled""",
)
def stacker_single(spark, folder):
    scores = views.model_scores(spark, folder)
    labels = views.interactions(spark, folder).groupBy(*KEYS).agg(F.max("like").alias("label"))
    rows = materialize(stacking.stacking_rows({"mf": scores["mf"]}, labels))
    model = stacking.fit_stacker(rows, ["mf"])
    table = stacking.coefficients(spark, {"like": model}, ["mf"])
    return writers.rounded(table.drop("engagement"), 6)


@query("stacker_fit")
def stacker_fit(spark, folder):
    """Ensemble scores of the second held-out part."""
    parts = _stacking(spark, folder)
    return stacking.stack(parts["test"], stacking.fit_stackers(parts["ensemble_train"], _MODELS), _MODELS)


def _judged(parts: dict[str, DataFrame]) -> DataFrame:
    """Every base model and the ensemble, judged on the second held-out part."""
    stackers = stacking.fit_stackers(parts["ensemble_train"], _MODELS)
    scored = materialize(stacking.stack(parts["test"], stackers, _MODELS))
    scores = {name: name for name in _MODELS} | {"Ensemble": "prediction"}
    tables = [
        evaluation.evaluation_table(_of(scored, e), "label", scores, ENSEMBLE_THRESHOLDS).withColumn("engagement", F.lit(e))
        for e in LABELS
    ]
    return reduce(DataFrame.unionByName, tables)


@query("stacker_evaluate")
def stacker_evaluate(spark, folder):
    return _judged(_stacking(spark, folder))


@query("stacker_job")
def stacker_job(spark, folder):
    """As ``stacker_evaluate``, over the forests that the whole grid chooses."""
    return _judged(_stacking(spark, folder, tuned=True))


@query("stacker_coefficients")
def stacker_coefficients(spark, folder):
    train = _stacking(spark, folder)["ensemble_train"]
    return stacking.weights(stacking.fit_stackers(train, _MODELS), _MODELS)


@query(
    "stacker_equations",
    f"""WITH {oracle.MODEL_SCORES}, {oracle.INTERACTIONS},
        labels AS (SELECT engaging_user_id, tweet_id, engagement, max(y) AS y
                   FROM (UNPIVOT (SELECT engaging_user_id, tweet_id, "like", reply, retweet, retweet_with_comment
                                  FROM interactions)
                         ON "like", reply, retweet, retweet_with_comment INTO NAME engagement VALUE y) GROUP BY ALL),
        joined AS (SELECT engagement, mf, rf, nncf, y FROM mf JOIN rf USING (engaging_user_id, tweet_id)
                   JOIN nncf USING (engaging_user_id, tweet_id) JOIN labels USING (engaging_user_id, tweet_id)),
        scaled AS (
          SELECT engagement, y,
                 (mf - min(mf) OVER e) / (max(mf) OVER e - min(mf) OVER e) AS a,
                 (rf - min(rf) OVER e) / (max(rf) OVER e - min(rf) OVER e) AS b,
                 (nncf - min(nncf) OVER e) / (max(nncf) OVER e - min(nncf) OVER e) AS c
          FROM joined WINDOW e AS (PARTITION BY engagement)),
        m AS (
          SELECT engagement, avg(y) AS y0, avg(a) AS a0, avg(b) AS b0, avg(c) AS c0,
                 var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc, covar_pop(a, b) AS ab,
                 covar_pop(a, c) AS ac, covar_pop(b, c) AS bc,
                 covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy
          FROM scaled GROUP BY engagement),
        solved AS (
          SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det,
                 ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy) AS da,
                 aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac) AS db,
                 aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac) AS dc
          FROM m)
        SELECT engagement, round(da / det, 6) AS mf, round(db / det, 6) AS rf, round(dc / det, 6) AS nncf,
               round(y0 - (da * a0 + db * b0 + dc * c0) / det, 6) AS intercept
        FROM solved""",
)
def stacker_equations(spark, folder):
    """Stackers of all labels over given score tables."""
    log = views.interactions(spark, folder).groupBy(*KEYS).agg(*[F.max(e).alias(e) for e in LABELS])
    long = log.select(*KEYS, F.explode(F.array(*[
        F.struct(F.lit(e).alias("engagement"), F.col(e).alias("label")) for e in LABELS
    ])).alias("of")).select(*KEYS, "of.*")
    joined = join_predictions(views.model_scores(spark, folder), list(KEYS)).join(long, list(KEYS))
    stackers = stacking.fit_stackers(joined, _MODELS)
    return writers.rounded(stacking.weights(stackers, _MODELS), 6)
