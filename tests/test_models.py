"""Invariants of fitted models, and the queries without oracle SQL."""

import pickle
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, FMClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from impressa.functions.hashing import table_checksum
from impressa.models import classify, features, grid, hashed, jobs, recommend, retrieval, stacking, trees
from impressa.models.recommend import ITEM_INDEX, USER_INDEX
from impressa.operators import ids, joins
from impressa.operators.sampling import fold_number
from impressa.plans import modelling
from impressa.sources import readers, views, writers
from impressa.sources.schemas import FIELD_SEPARATOR, ITEM, KEYS, LABELS, USER

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


# Queries of the optional part have tests of their own.
@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - set(ORACLES) - set(entry_points.LLM_QUERIES) - {"stacker_job"})
)
def test_query_gives_rows(spark, small, medium, name):
    # Factors of rank 50 need more than 50 engaged users and items.
    large = ("als_grid_search", "mf_job", "stacker_fit", "stacker_evaluate", "stacker_coefficients")
    folder = medium if name in large else small
    table = QUERIES[name](spark, folder).toArrow()
    assert table.num_rows > 0 and len(set(table.column_names)) == table.num_columns


# ---------------------------------------------------------------- feature vectors


@pytest.fixture(scope="module")
def log(spark, small):
    return views.impressions(spark, small).cache()


def test_fitted_features_are_reused_unchanged(spark, log):
    train = features.prepare(log.filter("row_id < 500"), keep=("row_id",))
    model = features.fit_features(train, 8, 12)
    unseen = log.limit(1).withColumns(
        {"language": F.lit("xx"), "tweet_type": F.lit(None).cast("string"), "tweet_timestamp": F.lit(4_000_000_000)}
    )
    test = features.prepare(unseen, keep=("row_id",))
    out = model.transform(test).select(
        vector_to_array("language_onehot").alias("language"),
        vector_to_array("tweet_type_onehot").alias("type"),
        vector_to_array("numeric_scaled").alias("numbers"),
        "like",
    ).first()
    assert not any(out["language"]) and not any(out["type"])
    assert out["numbers"][0] > 1  # Later than all train rows; not clipped.
    assert out["like"] in (0, 1)


def test_features_have_one_width_on_every_split(spark, log):
    prepared = features.prepare(log, keep=("row_id",))
    model = features.fit_features(prepared.filter("row_id < 500"), 8, 12)
    widths = features.features(model, prepared).select(F.size(vector_to_array(features.VECTOR))).distinct().collect()
    assert len(widths) == 1 and widths[0][0] > 3 + 8 + 12 + 7


def test_default_buckets_are_powers_of_two(spark, log):
    stages = features.stages()
    assert [s.getNumFeatures() for s in stages if hasattr(s, "getNumFeatures")] == [1024, 16384]


def test_items_hashed_once_give_the_same_vectors(spark, small, log):
    whole = features.prepare(log, keep=("row_id",))
    a = features.features(features.fit_features(whole, 8, 12), whole, keep=("row_id",))
    items = features.hash_items(views.item_attributes(spark, small), 8, 12)
    attached = views.attach(views.exposures(spark, small), items, views.user_attributes(spark, small))
    hashed = features.prepare_hashed(attached, keep=("row_id",))
    b = features.features(features.fit_features(hashed, hashed=True), hashed, keep=("row_id",))
    both = a.select("row_id", vector_to_array(features.VECTOR).alias("a")).join(
        b.select("row_id", vector_to_array(features.VECTOR).alias("b")), "row_id"
    )
    gaps = F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y)))
    assert both.count() == 1000 and both.agg(F.max(gaps)).first()[0] < 1e-9


def test_missing_hashtags_and_media_become_none(spark, log):
    row = features.prepare(log.filter("hashtags IS NULL AND present_media IS NULL")).first()
    assert row["hashtags"] == ["none"] and row["present_media"] == "[none]"


# ---------------------------------------------------------------- forests


def test_forest_probabilities(spark, log, tmp_path):
    prepared = features.prepare(log, keep=("row_id",))
    vectors = features.features(features.fit_features(prepared, 8, 12), prepared, keep=("row_id",)).cache()
    model = classify.fit_forest(vectors, "like", trees=5)
    scored = model.transform(vectors)
    rows = writers.class_predictions(scored).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["negative_probability"] + r["positive_probability"] == pytest.approx(1)
        assert r["prediction"] == float(r["positive_probability"] > r["negative_probability"])
    again = writers.class_predictions(classify.fit_forest(vectors, "like", trees=5).transform(vectors))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    writers.write_predictions(scored, str(tmp_path / "rf"))
    back = spark.read.csv(str(tmp_path / "rf"), header=True)
    assert back.columns == [ITEM, USER, "probability", "prediction"]
    assert back.filter(F.col("probability").rlike(r"^\[[0-9.E-]+,[0-9.E-]+\]$")).count() == 1000
    read = readers.read_class_predictions(spark, str(tmp_path / "rf")).collect()
    wanted = sorted((r[ITEM], r[USER], r["positive_probability"], r["prediction"]) for r in rows)
    assert sorted(map(tuple, read)) == wanted


# ---------------------------------------------------------------- factorisation


@pytest.fixture(scope="module")
def indexed(spark, small):
    log = views.interactions(spark, small).drop("value")
    indexes = {c: ids.dense_id_index(log, c) for c in (ITEM, USER)}
    return ids.encode_ids(log, indexes).cache(), indexes


def test_scores_equal_the_model_and_unknown_ids_score_zero(spark, indexed, monkeypatch):
    rows, _ = indexed
    model = recommend.fit_implicit(rows, "like", rank=4)
    pairs = rows.select(USER_INDEX, ITEM_INDEX).distinct()
    known = recommend.score_pairs(model, pairs, unknown=None)
    theirs = model.transform(pairs.select(*[F.col(c).cast("int").alias(c) for c in pairs.columns]))
    theirs = theirs.filter(~F.isnan("prediction")).withColumnRenamed("prediction", "theirs")
    joined = known.join(theirs, [USER_INDEX, ITEM_INDEX])
    assert known.count() == theirs.count() == joined.count() > 0
    assert joined.agg(F.max(F.abs(F.col("prediction") - F.col("theirs")))).first()[0] < 1e-5
    stranger = spark.createDataFrame([(10**6, 0)], f"{USER_INDEX} long, {ITEM_INDEX} long")
    assert recommend.score_pairs(model, stranger).first()["prediction"] == 0.0
    assert recommend.score_pairs(model, stranger, unknown=None).count() == 0
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 20)
    split = recommend.score_pairs(model, pairs, unknown=None)
    assert split.exceptAll(known).count() == 0 and split.count() == known.count()


def test_pairs_without_engagement_are_rated_zero(indexed):
    rows, _ = indexed
    rated = recommend.ratings(rows, "like")
    assert rated.count() == rows.select(USER_INDEX, ITEM_INDEX).distinct().count()
    assert rated.agg(F.sum("rating")).first()[0] == rows.agg(F.sum("like")).first()[0]


def scores(model, rows):
    pairs = rows.select(USER_INDEX, ITEM_INDEX).distinct()
    scored = recommend.score_pairs(model, pairs).collect()
    return {(r[USER_INDEX], r[ITEM_INDEX]): r["prediction"] for r in scored}


def test_ids_without_engagement_have_factors_and_change_the_fit(indexed):
    rows, _ = indexed
    rows = rows.withColumn("like", F.when(F.col(USER_INDEX) % 2 == 0, F.col("like")).otherwise(0))
    whole = recommend.fit_implicit(rows, "like", rank=3)
    engaged = recommend.fit_implicit(rows.filter("like = 1"), "like", rank=3)
    assert whole.userFactors.count() == rows.select(USER_INDEX).distinct().count()
    assert engaged.userFactors.count() < whole.userFactors.count()
    both = rows.filter("like = 1")
    a, b = scores(whole, both), scores(engaged, both)
    assert max(abs(a[k] - b[k]) for k in a) > 1e-4


def test_scores_do_not_depend_on_the_number_of_partitions(spark, indexed):
    rows, _ = indexed
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append(scores(recommend.fit_implicit(rows, "like", rank=3), rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    assert max(abs(found[0][k] - found[1][k]) for k in found[0]) < 1e-4


def test_factorisation_job_covers_every_part_pair_and_label(spark, indexed, tmp_path):
    rows, indexes = indexed
    pairs = rows.select(USER_INDEX, ITEM_INDEX).distinct()
    parts = {"a": pairs.filter(f"{USER_INDEX} % 2 = 0"), "b": pairs}
    n = parts["a"].count() + pairs.count()
    run = lambda alpha=10.0: jobs.factorisation_job(
        rows, parts, indexes, rank=3, alpha=alpha, labels=["like", "reply"], model_folder=str(tmp_path)
    )
    first = run()
    assert first.count() == 2 * n
    assert first.select("part", *KEYS, "engagement").distinct().count() == 2 * n
    names = {
        jobs.factorisation_name(e, 3, 10.0, table_checksum(recommend.ratings(rows, e))) for e in ("like", "reply")
    }
    assert {p.name for p in tmp_path.glob("als-*")} == names
    assert run().exceptAll(first).count() == 0
    writers.write_by_label(first, str(tmp_path / "out"))
    written = spark.read.option("sep", FIELD_SEPARATOR).csv(str(tmp_path / "out"), header=True)
    assert {ITEM, USER, "prediction", "engagement"} <= set(written.columns)
    assert written.groupBy("engagement").count().count() == 2 and written.count() == first.count()
    wrong = first.filter((F.col("prediction") >= 0.001).cast("int") != F.col("prediction_bool"))
    assert wrong.count() == 0


def test_models_of_other_settings_are_not_reused(indexed, tmp_path):
    rows, indexes = indexed
    parts = {"all": rows.select(USER_INDEX, ITEM_INDEX).distinct()}
    one, other = (
        {tuple(r[k] for k in KEYS): r["prediction"] for r in jobs.factorisation_job(
            rows, parts, indexes, rank=3, alpha=alpha, labels=["like"], model_folder=str(tmp_path)
        ).collect()}
        for alpha in (1.0, 1.9)
    )
    assert one.keys() == other.keys() and any(abs(one[k] - other[k]) > 1e-6 for k in one)


def test_models_of_other_rows_are_not_reused(indexed, tmp_path):
    rows, indexes = indexed
    parts = {"all": rows.select(USER_INDEX, ITEM_INDEX).distinct()}
    run = lambda train: {
        tuple(r[k] for k in KEYS): r["prediction"] for r in jobs.factorisation_job(
            train, parts, indexes, rank=3, labels=["like"], model_folder=str(tmp_path)
        ).collect()
    }
    one = run(rows)
    # The same rows in another order are the same model, fewer rows are another.
    assert run(rows.orderBy(F.rand(3)).repartition(3)) == one
    assert len(list(tmp_path.glob("als-*"))) == 1
    other = run(rows.filter("row_id % 5 > 0"))
    assert len(list(tmp_path.glob("als-*"))) == 2
    assert any(abs(one[k] - other[k]) > 1e-6 for k in one)


def test_checksum_follows_content_and_not_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, t string")
    name = table_checksum(df)
    assert table_checksum(df.orderBy("t").repartition(3).select("t", "k")) == name
    others = [df.distinct(), df.limit(0), df.withColumn("k", F.col("k").cast("long")), df.withColumnRenamed("t", "u"),
              df.union(df.limit(1)), spark.createDataFrame([(2, "a"), (1, None), (2, None)], "k int, t string")]
    assert len({name, *map(table_checksum, others)}) == 1 + len(others)


@pytest.fixture(scope="module")
def vectors(log):
    prepared = features.prepare(log, keep=("row_id",))
    return features.features(features.fit_features(prepared, 8, 12), prepared, keep=("row_id",)).cache()


def test_tuned_forests_predict_both_parts(vectors, tmp_path):
    parts = {"a": vectors.filter("row_id < 40"), "b": vectors.filter("row_id >= 960")}
    results, predictions = jobs.tuned_forest_job(
        vectors, parts, ["row_id"], labels=["like", "reply"], settings=grid.grid((2,), (2, 3), (1,)), folds=2,
        folder=str(tmp_path),
    )
    assert results.count() == 4 and set(results.columns) >= {"engagement", "areaUnderPR"}
    counts = {(r["part"], r["engagement"]): r["count"] for r in predictions.groupBy("part", "engagement").count().collect()}
    assert counts == {(p, e): 40 for p in "ab" for e in ("like", "reply")}


def test_grid_goes_on_where_it_was(vectors, tmp_path, monkeypatch):
    fits, run = [], grid._run

    def once(spark, rows, job, seed, path):
        if len(fits) == 3:
            raise RuntimeError("driver lost")
        fits.append(job)
        run(spark, rows, job, seed, path)

    settings = grid.grid((2,), (2, 4), (1, 3))
    search = lambda: grid.search(vectors, ["like"], ["row_id"], settings, folds=2, parallelism=1, folder=str(tmp_path))
    monkeypatch.setattr(grid, "_run", once)
    with pytest.raises(RuntimeError):
        search()
    monkeypatch.setattr(grid, "_run", lambda *a: (fits.append(a[2]), run(*a)))
    metrics = search().collect()
    # Every job ran once, the dearest first, and the result has them all.
    assert len(fits) == len(set(fits)) == len(metrics) == 8
    assert [j.setting.cost for j in fits] == sorted((j.setting.cost for j in fits), reverse=True)
    assert search().count() == 8 and len(fits) == 8
    assert grid.search(vectors, ["like"], ["row_id"], settings[:1], folds=2, folder=str(tmp_path)).count() == 2


def test_grid_equals_the_library_s_cross_validation(vectors, tmp_path):
    settings = grid.grid((3,), (2, 4), (1,))
    metrics = grid.search(vectors, ["like"], ["row_id"], settings, folds=3, folder=str(tmp_path))
    found = {(r["maxDepth"]): r["areaUnderPR"] for r in grid.results(metrics).collect()}
    estimator = classify.forest("like", 3)
    maps = ParamGridBuilder().addGrid(estimator.maxDepth, [2, 4]).build()
    judge = BinaryClassificationEvaluator(labelCol="like", metricName="areaUnderPR")
    rows = vectors.withColumn("fold", fold_number(3, classify.SEED, "row_id"))
    library = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=judge, numFolds=3, foldCol="fold"
    ).fit(rows)
    # Drawing rows for trees follows partitions, so the areas are near and not equal.
    assert found == pytest.approx(dict(zip([2, 4], library.avgMetrics, strict=True)), abs=0.05)
    best = grid.best_settings(metrics)["like"]
    assert found[best.depth] == max(found.values())
    assert {r["fits"] for r in grid.costs(metrics).collect()} == {3}


def test_grid_folder_follows_the_rows(vectors):
    assert grid.search_folder(vectors) == grid.search_folder(vectors.repartition(3))
    assert grid.search_folder(vectors) != grid.search_folder(vectors.filter("row_id > 0"))


def test_the_whole_grid_is_the_default():
    assert (classify.TREES, classify.DEPTHS, classify.MIN_ROWS, classify.FOLDS) == ((20, 50), (5, 10, 25), (1, 3), 5)


def test_split_job_gives_every_test_id_a_train_row(spark, small):
    log = views.interactions(spark, small, "tinyint").drop("value")
    train, test, indexes = jobs.split_job(log, n_test=900)
    assert test.count() == 900 and train.count() >= 100
    for column in (ITEM_INDEX, USER_INDEX):
        assert test.select(column).subtract(train.select(column)).count() == 0
    assert set(indexes) == {ITEM, USER}


def test_best_items_equal_the_library_s(spark, small):
    bought = views.purchases(spark, small).select(
        F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "rating"
    )
    model = recommend.fit_explicit(bought, "user", "item", "rating")
    library = recommend.recommendations(model.recommendForAllUsers(7), "user", "item").collect()
    found = retrieval.best_by_factors(model.userFactors, model.itemFactors, 7).collect()
    by_rank = lambda rows, key: {(r[key], r["rank"]): r["score"] for r in rows}
    assert by_rank(found, "query") == pytest.approx(by_rank(library, "user"), rel=1e-5)


def test_best_items_stop_early_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 20)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 9)
    rng = random.Random(8)
    # A few long vectors rule most items out; whole numbers make ties.
    items = [(i, [float(rng.randint(-9, 9)) * (20 if i % 40 == 0 else 1) for _ in range(3)]) for i in range(500)]
    queries = [(i, [float(rng.randint(-9, 9)) for _ in range(3)]) for i in range(30)] + [(99, [0.0, 0.0, 0.0])]
    schema = "id int, features array<float>"
    found = retrieval.best_by_factors(spark.createDataFrame(queries, schema), spark.createDataFrame(items, schema), 4)
    want = {}
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in items)[:4]
        want |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scored, 1)}
    assert {(r["query"], r["rank"]): (r["item"], r["score"]) for r in found.collect()} == want
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_best_items_send_a_query_to_the_blocks_that_matter_only(spark, monkeypatch):
    whole = retrieval._cell

    def checked(k):
        best = whole(k)

        def cell(queries, items):
            tops = items["norm"].to_pylist()
            for norm, kth in zip(queries["norm"].to_pylist(), queries["kth"].to_pylist(), strict=True):
                if tops and norm * max(tops) * 1.001 < kth:
                    raise ValueError("sent in vain")
            return best(queries, items)

        return cell

    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 4)
    monkeypatch.setattr(retrieval, "_cell", checked)
    schema = "id int, features array<float>"
    items = spark.createDataFrame([(i, [10.0 if i < 8 else 0.01]) for i in range(12)], schema)
    found = retrieval.best_by_factors(spark.createDataFrame([(1, [1.0])], schema), items, 4).collect()
    assert sorted((r["rank"], r["item"]) for r in found) == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_bounds_of_best_scores_are_close():
    scores = np.random.default_rng(3).normal(size=(50, 4003))
    bound, kth = retrieval._lower_bound(scores, 10), np.sort(scores, axis=1)[:, -10]
    assert (bound <= kth).all() and ((scores >= bound[:, None]).sum(axis=1) < 20).all()
    assert (retrieval._lower_bound(scores[:, :100], 10) == np.sort(scores[:, :100], axis=1)[:, -10]).all()


def test_best_items_of_few_rows(spark):
    schema = "id int, features array<float>"
    some = spark.createDataFrame([(1, [1.0]), (2, [-2.0])], schema)
    none = some.limit(0)
    found = retrieval.best_by_factors(some, some, 5).collect()
    assert sorted((r["query"], r["rank"], r["item"]) for r in found) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]
    for a, b in ((none, some), (some, none), (none, none)):
        assert retrieval.best_by_factors(a, b, 5).collect() == []


def test_grid_search_scores_narrow_rows(spark, indexed, monkeypatch):
    rows, _ = indexed
    scored, score = [], recommend.score_pairs
    monkeypatch.setattr(recommend, "score_pairs", lambda m, r, **o: scored.append(r.columns) or score(m, r, **o))
    recommend.grid_search(rows, rows, [0.1], labels=["like"], alphas=[1.0], ranks=[2])
    assert scored == [[USER_INDEX, ITEM_INDEX, "like"]]


def test_grid_search_has_a_row_per_setting(spark, indexed):
    rows, _ = indexed
    table = recommend.grid_search(rows, rows, [0.1], labels=["like"], alphas=[1.0, 10.0], ranks=[2, 3])
    found = sorted((r["engagement"], r["alpha"], r["rank"]) for r in table.collect())
    assert found == [("like", a, k) for a in (1.0, 10.0) for k in (2, 3)]
    assert all(0 <= r["areaUnderPR-0.1"] <= 1 for r in table.collect())


def test_neural_scores_are_probabilities_of_every_pair(spark, indexed):
    rows, _ = indexed
    factors = recommend.fit_implicit(rows, "like", rank=4)
    vectors = recommend.factor_features(factors, rows.select("row_id", USER_INDEX, ITEM_INDEX, "like"))
    net = recommend.fit_neural(vectors, "like", rank=4, iterations=5)
    assert list(net.getLayers()) == [8, 4, 2, 2]
    scores = recommend.neural_scores(net, vectors)
    assert scores.count() == 1000
    assert scores.filter("prediction < 0 OR prediction > 1 OR prediction IS NULL").count() == 0


@pytest.fixture(scope="module")
def two_blocks(spark):
    """Users like items of their own half: 9 of 10 there, 1 of 10 elsewhere."""
    draw = random.Random(3)
    pairs = [(u, i) for u in range(60) for i in range(60) if draw.random() < 0.6]
    made = [(u, i, str(u), str(i), int(draw.random() < (0.9 if u % 2 == i % 2 else 0.1))) for u, i in pairs]
    columns = f"{USER_INDEX} int, {ITEM_INDEX} int, {USER} string, {ITEM} string, like int"
    return spark.createDataFrame(made, columns).randomSplit([0.7, 0.3], 5)


def area(scored):
    return BinaryClassificationEvaluator(labelCol="like", rawPredictionCol="prediction").evaluate(scored)


def test_the_net_learns_two_blocks(two_blocks):
    train, test = two_blocks
    factors = recommend.fit_implicit(train, "like", rank=4)
    net = recommend.fit_neural(recommend.factor_features(factors, train).cache(), "like", rank=4, iterations=40)
    assert area(recommend.neural_scores(net, recommend.factor_features(factors, test))) > 0.8


def test_hashed_pairs_learn_two_blocks(two_blocks):
    train, test = two_blocks
    model = hashed.fit(hashed.hashed_pairs(train, ["like"], 1 << 12).cache(), "like", iterations=150)
    scored = hashed.scores(model, hashed.hashed_pairs(test, ["like"], 1 << 12))
    assert area(scored) > 0.8
    assert scored.filter("prediction < 0 OR prediction > 1 OR prediction IS NULL").count() == 0


def test_hashed_pairs_of_unseen_and_null_ids_have_scores(spark, two_blocks):
    train, _ = two_blocks
    model = hashed.fit(hashed.hashed_pairs(train, ["like"], 1 << 10).cache(), "like", iterations=5)
    unseen = spark.createDataFrame([("new", "7"), (None, "7"), (None, None)], f"{USER} string, {ITEM} string")
    scored = hashed.scores(model, hashed.hashed_pairs(unseen, buckets=1 << 10)).collect()
    assert len(scored) == 3 and all(0 <= r["prediction"] <= 1 for r in scored)


def test_machines_of_all_labels_equal_the_library_s(spark):
    rng = random.Random(4)
    some = lambda: None if rng.random() < 0.1 else str(rng.randint(0, 30))
    rows = [(some(), some(), int(rng.random() < 0.3), int(rng.random() < 0.6)) for _ in range(400)]
    table = spark.createDataFrame(rows + rows[:90], f"{USER} string, {ITEM} string, like int, reply int")
    # So few buckets that ids share some.
    pairs = hashed.hashed_pairs(table, ["like", "reply"], 1 << 6).cache()
    assert hashed._blocks(pairs, ["like"]).agg(F.sum(F.size("rows"))).first()[0] < len(rows)
    for label, found in hashed.fit_all(pairs, ["like", "reply"], iterations=6).items():
        library = FMClassifier(
            labelCol=label, factorSize=8, maxIter=6, stepSize=0.1, initStd=0.1, regParam=1e-4, solver="adamW", seed=42
        ).fit(pairs)
        assert found.intercept == pytest.approx(library.intercept, rel=1e-9)
        assert found.linear == pytest.approx(library.linear.toArray(), abs=1e-9)
        assert found.factors == pytest.approx(library.factors.toArray(), abs=1e-9)
        want = library.transform(pairs).agg(F.sum(vector_to_array("probability")[1])).first()[0]
        assert hashed.scores(found, pairs).agg(F.sum("prediction")).first()[0] == pytest.approx(want, rel=1e-9)


def test_pairs_without_factors_are_counted(spark):
    known = [(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(12)]
    model = recommend.fit_explicit(spark.createDataFrame(known, "user int, item int, rating double"), "user", "item", "rating")
    asked = spark.createDataFrame(known[:20] + [(99, 1, 2.0), (1, 99, 2.0), (98, 98, 1.0)], "user int, item int, rating double")
    found = recommend.explicit_error(model, asked, "user", "item", "rating").first()
    assert (found["scored"], found["without_factors"]) == (20, 3) and 0 <= found["rmse"] < 3
    none = recommend.explicit_error(model, asked.filter("user > 90"), "user", "item", "rating").first()
    assert (none["rmse"], none["scored"], none["without_factors"]) == (None, 0, 2)


# ---------------------------------------------------------------- stacker


def test_stacker_keeps_its_scaler(spark):
    rows = [(f"u{i}", "t", i / 10, (i % 3) / 2, int(i > 5)) for i in range(11)]
    train = spark.createDataFrame(rows, f"{USER} string, {ITEM} string, a double, b double, label int")
    model = stacking.fit_stacker(train, ["a", "b"])
    test = train.withColumn("a", F.col("a") * 2)
    kept = stacking.stacked_scores(model, test).agg(F.max("prediction")).first()[0]
    refitted = stacking.stacked_scores(stacking.rescaled(model, test), test)
    assert refitted.agg(F.max("prediction")).first()[0] < kept
    base = stacking.stacked_scores(model, train).agg(F.max("prediction")).first()[0]
    assert refitted.agg(F.max("prediction")).first()[0] == pytest.approx(base)


def test_stacker_scores_all_models_on_the_same_rows(spark):
    schema = f"{USER} string, {ITEM} string"
    a = spark.createDataFrame([(f"u{i}", "t", i / 10) for i in range(10)], f"{schema}, a double")
    b = spark.createDataFrame([(f"u{i}", "t", 1 - i / 10) for i in range(5, 10)], f"{schema}, b double")
    y = spark.createDataFrame([(f"u{i}", "t", i % 2) for i in range(10)], f"{schema}, label int")
    rows = stacking.stacking_rows({"a": a, "b": b}, y)
    assert rows.count() == 5
    model = stacking.fit_stacker(rows, ["a", "b"])
    table = stacking.evaluate_stacker(model, rows, ["a", "b"], [0.5])
    assert sorted(r["model_name"] for r in table.collect()) == ["Ensemble", "a", "b"]
    coefficients = stacking.coefficients(spark, {"like": model}, ["a", "b"])
    assert coefficients.columns == ["engagement", "a", "b", "intercept"]


def test_labels_are_the_four_engagements():
    assert LABELS == ["like", "reply", "retweet", "retweet_with_comment"]


def test_stacker_job_takes_the_forests_of_the_grid(spark, medium, monkeypatch):
    asked = {}
    monkeypatch.setattr(modelling.grid, "search", lambda train, labels, keys: labels)
    monkeypatch.setattr(
        modelling.grid, "best_settings", lambda labels: {e: grid.Setting(2 + i, 3, 1) for i, e in enumerate(labels)}
    )
    fit = jobs.fit_forests
    monkeypatch.setattr(jobs, "fit_forests", lambda train, settings: asked.update(settings) or fit(train, settings))
    table = modelling.stacker_job(spark, medium).collect()
    assert [s.trees for s in asked.values()] == [2, 3, 4, 5]
    assert {(r["engagement"], r["model_name"]) for r in table} == {
        (e, m) for e in LABELS for m in ("mf", "rf", "nncf", "Ensemble")
    }


def test_stackers_agree_with_the_library(spark):
    rng = random.Random(5)
    rows = []
    for engagement in ("like", "reply"):
        for _ in range(300):
            a, b = rng.random() * 5 - 2, rng.random()
            rows.append((engagement, a, b, int(a * 0.2 + b + rng.random() > 1), a + b))
    df = spark.createDataFrame(rows, "engagement string, a double, b double, label int, both double").cache()
    stackers = stacking.fit_stackers(df, ["a", "b"])
    scored = stacking.stack(df, stackers, ["a", "b"])
    for engagement in ("like", "reply"):
        one = df.filter(F.col("engagement") == engagement)
        model = stacking.fit_stacker(one, ["a", "b"])
        library = stacking.coefficients(spark, {engagement: model}, ["a", "b"]).first()
        found = stacking.weights(stackers, ["a", "b"]).filter(F.col("engagement") == engagement).first()
        assert [found[c] for c in ("a", "b", "intercept")] == pytest.approx([library[c] for c in ("a", "b", "intercept")])
        want = sorted(r["prediction"] for r in stacking.stacked_scores(model, one).collect())
        assert sorted(r["prediction"] for r in scored.filter(F.col("engagement") == engagement).collect()) == pytest.approx(want)
    # A combination of earlier scores and a constant add nothing; null scores are left out.
    more = df.withColumn("same", F.lit(3.0)).unionByName(
        df.limit(5).withColumn("same", F.lit(3.0)).withColumn("a", F.lit(None).cast("double"))
    )
    wide = stacking.weights(stacking.fit_stackers(more, ["a", "b", "both", "same"]), ["a", "b", "both", "same"])
    for r, plain in zip(wide.orderBy("engagement").collect(), stacking.weights(stackers, ["a", "b"]).orderBy("engagement").collect(), strict=True):
        assert (r["both"], r["same"]) == (0, 0)
        assert [r["a"], r["b"], r["intercept"]] == pytest.approx([plain["a"], plain["b"], plain["intercept"]])
    assert stacking.fit_stackers(df.limit(0), ["a", "b"]).count() == 0


def test_prepared_rows_are_written_without_their_texts(spark, small, monkeypatch):
    """The hashed text is written once an item, not once an impression."""
    written = []

    def kept(df):
        written.append(df.columns)
        return df.localCheckpoint()

    monkeypatch.setattr(modelling, "materialize", kept)
    train, test = modelling._prepared(spark, small)
    assert [("tweet_text_tf" in c, "row_id" in c) for c in written] == [(True, False), (False, True)]
    assert {"tweet_text_tf", "hashtags_tf", "row_id"} <= set(train.columns) and train.count() > test.count() > 0


def test_parts_share_their_forests(spark, monkeypatch):
    rows = spark.range(60).select(
        F.col("id").cast("string").alias(ITEM), F.lit("u").alias(USER), *[(F.col("id") % 2).cast("int").alias(e) for e in LABELS],
        array_to_vector(F.array((F.col("id") % 2).cast("double"), F.lit(1.0))).alias(features.VECTOR),
    ).localCheckpoint()
    fits = []
    fit = jobs.fit_forest
    monkeypatch.setattr(jobs, "fit_forest", lambda *a, **b: fits.append(a[1]) or fit(*a, **b))
    parts = {"first": rows.filter("tweet_id < 10"), "second": rows.filter("tweet_id >= 10")}
    both = jobs.forest_job(rows, parts, trees=2)
    assert fits == list(LABELS)
    assert {(r["part"], r["n"]) for r in both.groupBy("part").agg(F.count("*").alias("n")).collect()} == {("first", 40), ("second", 200)}
    alone = jobs.forest_job(rows, parts["second"], trees=2)
    assert "part" not in alone.columns
    assert both.filter("part = 'second'").drop("part").exceptAll(alone).count() == 0


def test_forest_rows_lie_in_two_files_a_core(spark, small, monkeypatch):
    """A file per shuffle partition packs unevenly, so that a task of every pass runs alone."""
    files = []

    def kept(df):
        files.append(("row_id" in df.columns, df.rdd.getNumPartitions()))
        return df.localCheckpoint()

    monkeypatch.setattr(modelling, "materialize", kept)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "35")
    try:
        train, test = modelling._prepared(spark, small, modelling._FOREST_BUCKETS, whole=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [n for rows, n in files if rows] == [2 * spark.sparkContext.defaultParallelism]
    assert train.count() + test.count() == 1000


# ---------------------------------------------------------------- forests over whole texts


def test_forests_read_whole_texts(spark, small):
    for rows in modelling._forest_rows(spark, small):
        row = rows.select(vector_to_array(features.VECTOR).alias("v")).first()["v"]
        names = [a["name"] for kind in rows.schema[features.VECTOR].metadata["ml_attr"]["attrs"].values() for a in kind]
        assert len(row) == len(names)
        assert sum(n.startswith("hashtags_idf") for n in names) == 1024
        assert sum(n.startswith("tweet_text_idf") for n in names) == 16384


@pytest.fixture(scope="module")
def sparse_rows(spark):
    """600 rows: three numbers of their own and the text of one of 40 items, with the names of both."""
    draw = random.Random(8)
    items = [{s: draw.choice([1.0, 2.0, 2.5]) for s in range(2, 62) if draw.random() < 0.2} for _ in range(40)]
    rows = []
    for i in range(600):
        item = draw.randrange(40)
        slots = items[item] | {0: draw.gauss(0, 1), 1: float(draw.random() < 0.5), 62: draw.random()}
        like = int(2 * slots[0] + 3 * slots.get(7, 0) - 2 * slots.get(9, 0) + slots[62] + draw.gauss(0, 1) > 0.6)
        kept = sorted(s for s, v in slots.items() if v)
        rows.append((i, f"u{i % 50}", f"t{item}", like, Vectors.sparse(63, kept, [slots[s] for s in kept])))
    names = ["follows", "verified", *[f"tweet_text_idf_{s}" for s in range(60)], "numeric_scaled_0"]
    attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": 63}}
    table = spark.createDataFrame(rows, ["row_id", USER, ITEM, "like", "v"])
    return table.select("row_id", USER, ITEM, "like", F.col("v").alias(features.VECTOR, metadata=attrs)).cache()


def test_trees_follow_the_library_s_rules(sparse_rows, monkeypatch):
    """Without draws a tree is the library's tree: thresholds, gains, least rows, joined leaves."""
    monkeypatch.setattr(trees, "_draws", lambda ids, seed, number: np.ones(len(ids)))
    rows = trees.encoded(sparse_rows, ["like"])
    assert rows.slots.own.tolist() == [0, 1, 62]
    block = trees._merged(list(trees._loaded(rows.blocks.toArrow().to_batches())))
    assert (len(block.ids), block.patterns) == (600, 40)
    for depth, least in ((3, 1), (6, 3), (9, 10)):
        limits = trees.Limits(depth, least, 63)
        tree = trees._grow(block, rows.slots, np.arange(600), block.labels[:, 0] > 0, 0, limits, 1)
        mine = trees.ForestModel([tree], rows.slots, depth).transform(sparse_rows)
        library = DecisionTreeClassifier(
            labelCol="like", featuresCol=features.VECTOR, maxDepth=depth, minInstancesPerNode=least
        ).fit(sparse_rows).transform(sparse_rows)
        want, found = (
            {r["row_id"]: r["p"] for r in t.select("row_id", vector_to_array("probability")[1].alias("p")).collect()} for t in (library, mine)
        )
        differ = sum(abs(found[k] - want[k]) > 1e-9 for k in want)
        # Equal gains are settled in another order, which deep in a tree moves a few rows.
        assert differ <= (0 if depth == 3 else 30), (depth, differ)


def shapes(forest):
    return [[getattr(t, n).tolist() for n in ("slot", "bin", "left", "right", "counts")] for t in forest]


def test_levels_over_blocks_grow_the_same_trees(sparse_rows, monkeypatch):
    rows = trees.encoded(sparse_rows.repartition(5), ["like"])
    whole = trees.fit(rows, "like", 4, 7)
    monkeypatch.setattr(trees, "LOCAL_BYTES", 0)
    monkeypatch.setattr(trees, "_PASS_NODES", 5)
    assert shapes(trees.fit(rows, "like", 4, 7)) == shapes(whole)
    # Other partitions, other order: the same forest.
    assert shapes(trees.fit(trees.encoded(sparse_rows.orderBy(F.rand(2)).coalesce(2), ["like"]), "like", 4, 7)) == shapes(whole)


def test_many_patterns_and_blocks_grow_the_same_trees(sparse_rows, monkeypatch):
    whole = trees.fit(trees.encoded(sparse_rows, ["like"]), "like", 3, 6)
    for name, value in (("BLOCK_PATTERNS", 7), ("BLOCK_ROWS", 50), ("_NODES", 3), ("_ENTRIES", 20)):
        monkeypatch.setattr(trees, name, value)
    assert shapes(trees.fit(trees.encoded(sparse_rows, ["like"]), "like", 3, 6)) == shapes(whole)


def test_rows_alike_are_drawn_one_by_one(sparse_rows):
    same = sparse_rows.filter("row_id = 3").crossJoin(sparse_rows.sparkSession.range(400).select(F.lit(1).alias("one"))).drop("one")
    block = trees._merged(list(trees._loaded(trees.encoded(same.coalesce(1), ["like"]).blocks.toArrow().to_batches())))
    drawn = trees._draws(block.ids, 42, 0)
    assert len(drawn) == 400 and 300 < drawn.sum() < 500 and len(set(drawn)) > 3


def test_a_family_of_forests_is_fitted_once_and_each_judged_as_if_alone(sparse_rows, tmp_path, monkeypatch):
    asked, areas = [], grid.growth.areas
    monkeypatch.setattr(grid.growth, "areas", lambda *a: asked.append(a[1:6]) or areas(*a))
    settings = grid.grid((2, 4), (2, 5), (1, 3))
    metrics = grid.search(sparse_rows, ["like"], ["row_id"], settings, folds=2, folder=str(tmp_path)).collect()
    assert sorted((a[3], a[4]) for a in asked) == [(1, 0), (1, 1), (3, 0), (3, 1)] and len(metrics) == 16
    rows = sparse_rows.withColumn("fold", fold_number(2, grid.SEED, "row_id"))
    judge = BinaryClassificationEvaluator(labelCol="like", rawPredictionCol="probability", metricName="areaUnderPR", numBins=0)
    known = trees.encoded(rows, ["like"], "fold")
    for r in metrics:
        alone = trees.fit(known, "like", r["numTrees"], r["maxDepth"], r["minInstancesPerNode"], grid.SEED, r["fold"])
        model = trees.ForestModel(alone, known.slots, r["maxDepth"])
        assert r["areaUnderPR"] == pytest.approx(judge.evaluate(model.transform(rows.filter(F.col("fold") == r["fold"]))), abs=1e-9)
    # Rows that are too many for one task give the same areas.
    monkeypatch.setattr(trees, "LOCAL_BYTES", 0)
    found = trees.areas(known, "like", [2, 4], [2, 5], 3, 1, grid.SEED)
    want = {(r["numTrees"], r["maxDepth"]): r["areaUnderPR"] for r in metrics if r["minInstancesPerNode"] == 3 and r["fold"] == 1}
    assert found == pytest.approx(want, abs=1e-9)


def test_thresholds_go_to_tasks_only_where_values_are_read(spark, small):
    """Each of the 240 jobs of a grid sends them else, 31 numbers for each of 17,000 slots."""
    train, _ = modelling._forest_rows(spark, small)
    slots = trees.encoded(train, LABELS).slots
    back = pickle.loads(pickle.dumps(slots))
    assert np.array_equal(back.splits, slots.splits) and back.splits.shape[0] == back.count > 17408
    assert np.array_equal(slots.bins(np.arange(slots.count), np.zeros(slots.count)), slots.zero)
    assert len(pickle.dumps(slots.light)) < 100_000 < slots.splits.nbytes
