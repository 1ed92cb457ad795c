"""Operators against brute force on small fixtures, and their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from impressa.functions import labels, numbers, similarity, text
from impressa.operators import (
    aggregates,
    bootstrap,
    cleaning,
    colocated,
    coldstart,
    evaluation,
    ids,
    joins,
    ordering,
    profiles,
    sampling,
    sketches,
    textweights,
)
from impressa.plans import textual
from impressa.sources.schemas import ITEM, KEYS, LABELS, USER


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


# ---------------------------------------------------------------- numbering


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_number_rows_is_dense_and_ordered(spark, n):
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("key"))
    numbered = ordering.number_rows(df, ["key"]).collect()
    by_key = sorted(numbered, key=lambda r: r["key"])
    assert [r["row_index"] for r in by_key] == list(range(n))


def test_number_rows_descending(spark):
    df = spark.range(100).select("id")
    numbered = ordering.number_rows(df, [F.desc("id")])
    assert all(r["row_index"] == 99 - r["id"] for r in numbered.collect())


def test_running_totals_over_many_partitions(spark):
    rng = random.Random(1)
    data = [(i, rng.randint(0, 9), rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, a int, b int").repartition(5)
    a = b = 0
    for r in sorted(ordering.running_totals(df, ["k"], ["a", "b"]).collect()):
        a, b = a + r["a"], b + r["b"]
        assert (r["cum_a"], r["cum_b"]) == (a, b)


def test_running_totals_by_exclusive_or(spark):
    rng = random.Random(2)
    data = [(i, rng.randint(0, 9), rng.getrandbits(62)) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, a int, x bigint").repartition(7)
    a = x = 0
    for r in sorted(ordering.running_totals(df, ["k"], ["a"], ["x"]).collect()):
        a, x = a + r["a"], x ^ r["x"]
        assert (r["cum_a"], r["cum_x"]) == (a, x)


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = ordering.top_k(df, "g", [F.desc("v")], 2)
    assert rows(top, "g", "v", "rank") == [
        (0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# ---------------------------------------------------------------- joins


def _skewed(spark):
    """A third of all rows in one key."""
    return spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k")
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 100)
    facts = _skewed(spark).unionByName(spark.createDataFrame([(-5, None), (-6, 777)], "row long, k long"))
    lookup = spark.range(-1, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spread = joins.spread_join(facts, lookup, "k", "row", how)
    plain = facts.join(lookup, "k", how)
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_spread_join_leaves_no_task_with_the_frequent_key(spark, monkeypatch):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        lookup = spark.range(-1, 50).select(F.col("id").alias("k"))
        largest = {}
        for limit in (10**6, 50):
            monkeypatch.setattr(joins, "HOT_KEY_ROWS", limit)
            joined = joins.spread_join(_skewed(spark), lookup, "k", "row")
            sizes = joined.groupBy(F.spark_partition_id()).count()
            largest[limit] = max(r["count"] for r in sizes.collect())
            assert joined.count() == 3000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert largest[10**6] > 1000 and largest[50] < 700


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_large_id_tables_split_frequent_ids(spark, monkeypatch, how):
    facts = _skewed(spark).unionByName(spark.createDataFrame([(-5, None)], "row long, k long"))
    wanted = spark.range(-1, 10).select(F.col("id").alias("k"))
    filtered = cleaning.keep_ids if how == "left_semi" else cleaning.remove_ids
    expected = facts.join(wanted, "k", how).orderBy("row").select("row", "k").collect()
    assert filtered(facts, wanted).orderBy("row").select("row", "k").collect() == expected
    monkeypatch.setattr(cleaning, "_SMALL_TABLE_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 50)
    assert filtered(facts, wanted).orderBy("row").select("row", "k").collect() == expected


def test_hot_keys_are_found_with_enough_pieces(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 100)
    assert rows(joins.hot_keys(_skewed(spark), "k")) == [(-1, 10)]
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 5000)
    assert joins.hot_keys(_skewed(spark), "k") is None


def test_spread_join_refuses_joins_that_salts_would_change(spark):
    with pytest.raises(ValueError):
        joins.spread_join(spark.range(1), spark.range(1), "id", "id", "full")


def test_repeated_keys_are_not_multiplied(spark):
    a = spark.createDataFrame([("u", "i", 0.2), ("u", "i", 0.4)], f"{USER} string, {ITEM} string, a double")
    b = spark.createDataFrame([("u", "i", 0.5), ("u", "i", 0.5)], f"{USER} string, {ITEM} string, b double")
    y = spark.createDataFrame([("u", "i", 1), ("u", "i", 1)], f"{USER} string, {ITEM} string, label int")
    joined = joins.join_labels(joins.join_predictions({"a": a, "b": b}, KEYS), y, KEYS)
    [row] = joined.collect()
    assert row["a"] == pytest.approx(0.3) and row["b"] == 0.5 and row["label"] == 1


def test_encode_drops_unknown_ids_and_decode_is_inverse(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "id string, x int")
    index = ids.dense_id_index(df.filter("id <> 'c'"), "id")
    encoded = ids.encode_ids(df, {"id": index})
    assert rows(encoded, "x", "id_index") == [(1, 1), (2, 0)]
    assert rows(ids.decode_ids(encoded, {"id": index}), "x", "id") == [(1, "b"), (2, "a")]


def test_first_ids_by_limit_and_by_number(spark, monkeypatch):
    df = spark.range(100).select((F.col("id") % 20).alias("id"))
    expected = [(i,) for i in range(7)]
    assert rows(cleaning.first_ids(df, "id", 7)) == expected
    monkeypatch.setattr(cleaning, "_LIMIT_ROWS", 3)
    assert rows(cleaning.first_ids(df, "id", 7)) == expected


# ---------------------------------------------------------------- labels and text


def test_labels_from_timestamps(spark):
    schema = ", ".join(f"{e}_timestamp long" for e in LABELS)
    df = spark.createDataFrame([(None, None, None, None), (0, None, 5, None)], schema)
    assert rows(labels.with_labels(df, "tinyint")) == [(0, 0, 0, 0), (1, 0, 1, 0)]
    assert [t for _, t in labels.with_labels(df, "tinyint").dtypes] == ["tinyint"] * 4


def test_threshold_is_inclusive_and_null_is_negative(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (None,)], "p double")
    assert [r[0] for r in df.select(labels.at_least("p", 0.5)).collect()] == [1, 0, 0]


def test_tokens(spark):
    df = spark.createDataFrame([("A\tB\t\tc",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(text.tokens("x")).collect()] == [["a", "b", "c"], None, []]
    media = spark.createDataFrame([("Photo\tPhoto",)], "x string")
    category = text.list_category(text.tokens("x", text.WHITESPACE))
    assert media.select(category).first()[0] == "[photo, photo]"


def test_tokens_equal_the_ml_tokenizer(spark, small):
    from pyspark.ml.feature import RegexTokenizer

    documents = spark.read.parquet(f"{small}/documents.parquet")
    theirs = RegexTokenizer(inputCol="text", outputCol="t").transform(documents)
    assert theirs.filter(text.tokens("text", text.WHITESPACE) != F.col("t")).count() == 0


def test_positive_probability_of_printed_vectors(spark):
    df = spark.createDataFrame([("[0.25,0.75]",), ("[1.0,1.0E-4]",), ("broken",)], "p string")
    assert [r[0] for r in df.select(text.positive_probability("p")).collect()] == [0.75, 1e-4, None]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    found = [r[0] for r in df.select(similarity.cosine("a", "b")).collect()]
    assert found[0] == pytest.approx(2**-0.5) and found[1] is None


# ---------------------------------------------------------------- sampling


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_lowest_n_is_exact(spark, n):
    df = spark.range(1000)
    train, test = sampling.split_fixed_size(df, n, 3, "id")
    assert test.count() == min(n, 1000) and train.count() == 1000 - min(n, 1000)


def test_lowest_n_finds_its_cut_within_one_range(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_STEP_BITS", 1)
    df = spark.range(500)
    _, test = sampling.split_fixed_size(df, 123, 3, "id")
    hashed = sorted((r["h"], r["id"]) for r in df.select(sampling.key_hash(3, "id").alias("h"), "id").collect())
    assert sorted(r["id"] for r in test.collect()) == sorted(i for _, i in hashed[:123])


def test_split_does_not_depend_on_partitioning(spark):
    one, _ = sampling.split(spark.range(1000).repartition(1), 0.7, 1, "id")
    many, rest = sampling.split(spark.range(1000).repartition(13), 0.7, 1, "id")
    assert rows(one) == rows(many)
    assert 650 < many.count() < 750 and many.count() + rest.count() == 1000


def test_bootstrap_draws_exactly_n_with_repeats(spark):
    df = spark.range(100).select(F.col("id").alias("key"), (F.col("id") * 2).alias("x"))
    sample = sampling.bootstrap(df, 1000, 19, "key")
    assert sample.count() == 1000
    assert sample.select("draw").distinct().count() == 1000
    assert 95 < sample.select("key").distinct().count() <= 100
    assert rows(sample) == rows(sampling.bootstrap(df.repartition(7), 1000, 19, "key"))


def test_cohort_keeps_all_rows_of_its_ids(spark):
    df = spark.range(1000).select((F.col("id") % 40).alias("user"), "id")
    cohort = sampling.sample_cohort(df, "user", 10, 5)
    assert cohort.select("user").distinct().count() == 10 and cohort.count() == 250


# ---------------------------------------------------------------- cold start


def _cold(spark, n_items, n_users):
    zero = [F.lit(0).cast("tinyint").alias(e) for e in LABELS]
    train = spark.createDataFrame([(10, 20), (11, 21)], "item long, user long").select("*", *zero)
    items = [(100 + i, 20) for i in range(n_items)]
    users = [(10, 200 + u) for u in range(n_users)]
    test = spark.createDataFrame([*items, *users, (10, 20)], "item long, user long").select("*", *zero)
    return train, test, {i for i, _ in items}, {u for _, u in users}


@pytest.mark.parametrize("fill", [coldstart.zipped_fill, coldstart.partnered_fill])
@pytest.mark.parametrize("sizes", [(3, 2), (2, 3), (0, 3), (3, 0), (0, 0)])
def test_fill_covers_every_missing_id(spark, fill, sizes):
    train, test, items, users = _cold(spark, *sizes)
    added = fill(train, test, "item", "user")
    pairs = [(r["item"], r["user"]) for r in added.collect()]
    assert items <= {i for i, _ in pairs} and users <= {u for _, u in pairs}
    assert len(pairs) == (max(sizes) if fill is coldstart.zipped_fill else sum(sizes))
    assert all(i in items | {10, 11} and u in users | {20, 21} for i, u in pairs)
    full = coldstart.full_train(train, added)
    assert full.count() == 2 + len(pairs)
    assert full.agg(F.sum("like")).first()[0] == 0


# ---------------------------------------------------------------- statistics


def test_minmax_scale_of_constant_and_unseen_values(spark):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 7.0), (2.0, 9.0)], "a double, b double")
    scaled = aggregates.minmax_scale(test, ["a", "b"], aggregates.minmax_bounds(train, ["a", "b"]))
    assert rows(scaled) == [(0.5, 0.5), (2.0, 0.5)]
    assembler = VectorAssembler(inputCols=["a", "b"], outputCol="v")
    scaler = MinMaxScaler(inputCol="v", outputCol="s").fit(assembler.transform(train))
    ml = scaler.transform(assembler.transform(test)).select(vector_to_array("s").alias("s"))
    assert sorted(tuple(r["s"]) for r in ml.collect()) == rows(scaled)


def test_histogram_counts_every_value(spark):
    values = [0.0, 0.1, 0.5, 0.99, 1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert rows(aggregates.histogram(df, "x", 10), "bin", "n") == [(0, 1), (1, 1), (5, 1), (9, 2)]
    constant = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert rows(aggregates.histogram(constant, "x", 10), "bin", "n") == [(5, 2)]


# ---------------------------------------------------------------- evaluation


def _scored(spark, seed=0, n=400):
    rng = random.Random(seed)
    data = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(n)]
    return spark.createDataFrame(data, "y int, s double")


@pytest.mark.parametrize("seed", [0, 1])
def test_areas_equal_the_ml_evaluator(spark, seed):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = _scored(spark, seed)

    def ml(column, metric):
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol=column, labelCol="y", metricName=metric, numBins=0
        )
        return evaluator.evaluate(df.withColumn("hard", (F.col("s") >= 0.3).cast("double")))

    areas = evaluation.aupr_thresholded(df, ["y"], "s", [0.3]).first()
    assert areas["aupr"] == pytest.approx(ml("hard", "areaUnderPR"), abs=1e-12)
    full = evaluation.aupr_full(df, ["y"], "s").first()["aupr"]
    assert full == pytest.approx(ml("s", "areaUnderPR"), abs=1e-12)
    assert evaluation.auroc(df, ["y"], "s").first()["auroc"] == pytest.approx(ml("s", "areaUnderROC"), abs=1e-12)


def test_area_is_the_base_rate_if_nothing_or_everything_is_chosen(spark):
    df = _scored(spark)
    base = df.agg(F.avg("y")).first()[0]
    areas = evaluation.aupr_thresholded(df, ["y"], "s", [2.0, -1.0])
    assert [r["aupr"] for r in areas.collect()] == [pytest.approx(base)] * 2


def test_area_without_positives_is_zero(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.9)], "y int, s double")
    assert evaluation.aupr_thresholded(df, ["y"], "s", [0.6]).first()["aupr"] == 0.0


def test_log_loss_skips_undefined_rows(spark):
    df = spark.createDataFrame([(1, s) for s in (0.0, 1.0, -0.2, 1.3, 0.5)], "y int, s double")
    parity = evaluation.log_loss(df, ["y"], "s").first()
    assert parity["log_loss"] == pytest.approx(np.log(2)) and parity["skipped"] == 4
    clipped = evaluation.log_loss(df, ["y"], "s", clipped=True).first()
    assert clipped["log_loss"] > 10 and clipped["skipped"] == 0


def test_evaluation_table_has_one_row_per_model(spark):
    df = _scored(spark).withColumn("t", 1 - F.col("s"))
    table = evaluation.evaluation_table(df, "y", {"a": "s", "b": "t"}, [0.5, 0.1])
    single = evaluation.aupr_thresholded(df, ["y"], "t", [0.1, 0.5])
    by_threshold = {r["threshold"]: r["aupr"] for r in single.collect()}
    row = {r["model_name"]: r for r in table.collect()}["b"]
    assert row["areaUnderPR-0.1"] == pytest.approx(by_threshold[0.1])
    assert row["areaUnderPR-0.5"] == pytest.approx(by_threshold[0.5])


# ---------------------------------------------------------------- text weights and profiles


def test_weights_equal_the_ml_stages(spark, small):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    counts = textweights.term_counts(documents, "doc_id", text.tokens("text", text.WHITESPACE))
    vocabulary = textweights.fit_vocabulary(counts, documents, "doc_id")
    weighted = textweights.weighted_terms(counts, vocabulary, "doc_id")
    ours = textweights.document_vectors(weighted, "doc_id").select("doc_id", F.inline("terms"))
    ours = {(r["doc_id"], r["term"]): r["weight"] for r in ours.join(vocabulary, "term_index").collect()}
    model = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="terms"),
            CountVectorizer(inputCol="terms", outputCol="tf"),
            IDF(inputCol="tf", outputCol="w"),
            Normalizer(inputCol="w", outputCol="unit"),
        ]
    ).fit(documents)
    words = model.stages[1].vocabulary
    cells = model.transform(documents).select("doc_id", F.posexplode(vector_to_array("unit")).alias("i", "w"))
    theirs = {(r["doc_id"], words[r["i"]]): r["w"] for r in cells.filter("w <> 0").collect()}
    nonzero = {k: w for k, w in ours.items() if w != 0}
    assert nonzero.keys() == theirs.keys()
    assert max(abs(nonzero[k] - theirs[k]) for k in theirs) < 1e-12


def test_vocabulary_weights_count_impressions(spark):
    texts = spark.createDataFrame([("i", "x y"), ("j", "x")], f"{ITEM} string, text string")
    counts = textweights.term_counts(texts, ITEM, text.tokens("text", text.WHITESPACE))
    shown = spark.createDataFrame([("i", 3), ("j", 1)], f"{ITEM} string, shown long")
    fitted = textweights.fit_vocabulary(counts, shown, ITEM, weight="shown")
    found = {r["term"]: (r["term_index"], r["df"], r["idf"]) for r in fitted.collect()}
    assert found["x"] == (0, 4, 0.0)
    assert found["y"] == (1, 3, pytest.approx(np.log(5 / 4)))


def test_profiles_and_scores_equal_dense_arithmetic(spark, monkeypatch):
    rng = np.random.default_rng(3)
    items = [f"i{k}" for k in range(6)]
    dense = {i: rng.random(4) for i in items}
    dense["i5"] = np.zeros(4)
    log = [(f"u{rng.integers(3)}", items[rng.integers(6)], *map(int, rng.integers(0, 2, 4))) for _ in range(60)]
    # One user has ignored everything, one is unknown to train.
    log += [("never", "i1", 0, 0, 0, 0), ("never", "i2", 0, 0, 0, 0)]
    schema = f"{USER} string, {ITEM} string, " + ", ".join(f"{e} int" for e in LABELS)
    entries = [(i, [(k, float(w)) for k, w in enumerate(v)]) for i, v in dense.items()]
    vectors = spark.createDataFrame(entries, f"{ITEM} string, terms array<struct<term_index:long,weight:double>>")
    train = spark.createDataFrame(log, schema)
    asked = [(u, i) for u in ("u0", "u1", "u2", "never", "new") for i in items] * 2
    test = spark.createDataFrame(asked, f"{USER} string, {ITEM} string")

    def mean(chosen):
        return np.mean(chosen, axis=0) if chosen else np.zeros(4)

    def expected(user, item, label):
        seen = [(dense[r[1]], r[2 + label]) for r in log if r[0] == user]
        profile = mean([v for v, y in seen if y]) - mean([v for v, y in seen if not y])
        length = np.linalg.norm(profile) * np.linalg.norm(dense[item])
        return None if length == 0 else (profile @ dense[item] / length + 1) / 2

    for limit in (10**6, 2):
        monkeypatch.setattr(joins, "HOT_KEY_ROWS", limit)
        monkeypatch.setattr(profiles, "HOT_USER_PAIRS", limit)
        built = profiles.profiles(profiles.pair_counts(train), vectors)
        scores = profiles.profile_scores(test, vectors, built).collect()
        assert len(scores) == 4 * 6
        for row in scores:
            for k, label in enumerate(LABELS):
                want = expected(row[USER], row[ITEM], k)
                assert row[label] == (None if want is None else pytest.approx(want, abs=1e-12))


def test_profiles_in_cells_of_any_size(spark, monkeypatch):
    """Scores and profiles do not depend on the cells, and no table of terms by pair is written."""
    n = 7
    items = [(f"i{k}", [(t, 1.0 + (t * k) % 5) for t in range(k % 3, 12, 1 + k % 2)]) for k in range(n)]
    items.append(("empty", []))
    vectors = spark.createDataFrame(items, f"{ITEM} string, terms array<struct<term_index:long,weight:double>>")
    log = [(f"u{k % 5}" if k % 11 else None, f"i{k * k % (n + 1)}", k % 2, k % 3 // 2, 0, 1) for k in range(90)]
    log += [("u1", "empty", 1, 0, 0, 1), ("u2", None, 0, 1, 0, 1)]
    schema = f"{USER} string, {ITEM} string, " + ", ".join(f"{e} int" for e in LABELS)
    train = spark.createDataFrame(log, schema)
    asked = [(u, f"i{k}") for u in ("u0", "u1", "u2", "new", None) for k in range(n + 2)] + [("u1", "empty")]
    test = spark.createDataFrame(asked, f"{USER} string, {ITEM} string")
    pairs = profiles.pair_counts(train)
    written = []

    def counted(df):
        written.append(df.count())
        return df.localCheckpoint()

    monkeypatch.setattr(profiles, "materialize", counted)
    seen = []
    for cell, most in ((1 << 20, 50_000), (40, 50_000), (3, 50_000), (1 << 20, 2)):
        monkeypatch.setattr(profiles, "CELL_TERMS", cell)
        monkeypatch.setattr(profiles, "HOT_USER_PAIRS", most)
        built = profiles.profiles(pairs, vectors)
        weighted = profiles.profiles(pairs, vectors, unfolded=False)
        scores = profiles.profile_scores(test, vectors, weighted)
        both = [built, profiles.class_means(pairs, vectors), scores, profiles.profile_scores(test, vectors, built)]
        seen.append([sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in b.collect()) for b in both])
        seen[-1][2:] = [sorted(map(str, b)) for b in seen[-1][2:]]
        assert seen[-1][2] == seen[-1][3]
        if cell == 1 << 20 and most > 2:
            assert max(written) <= pairs.count() + len(asked)
    assert all(s == seen[0] for s in seen)
    assert len(seen[0][2]) == 3 * n


def test_fast_rounding_equals_round(spark):
    rng = np.random.default_rng(5)
    halves = (np.arange(-400, 400) + 0.5) / 1e6
    values = [*halves, *np.nextafter(halves, 1), *np.nextafter(halves, -1), *rng.normal(size=3000), *rng.normal(size=500) * 1e-6]
    values += [0.0, -0.0, -1e-9, 1e300, -1e300, 4e9 + 0.1234565, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").localCheckpoint()
    for digits in (0, 3, 6, 9):
        found = df.select(F.round("x", digits).cast("string").alias("a"), numbers.rounded("x", digits).cast("string").alias("b"))
        assert found.filter("NOT a <=> b").collect() == []


def test_profile_class_weights(spark):
    schema = f"{USER} string, {ITEM} string, " + ", ".join(f"{e} int" for e in LABELS)
    log = spark.createDataFrame([("u", "i", 1, 0, 0, 0), ("u", "j", 0, 0, 0, 0)], schema)
    vectors = spark.createDataFrame(
        [("i", [(0, 1.0)]), ("j", [(1, 1.0)])], f"{ITEM} string, terms array<struct<term_index:long,weight:double>>"
    )
    built = profiles.profiles(profiles.pair_counts(log), vectors, positive=2.0, negative=0.5)
    assert rows(built, "term_index", "like") == [(0, 2.0), (1, -0.5)]


# ---------------------------------------------------------------- bounds that must not cut


def test_vocabulary_has_every_term(spark):
    n = (1 << 18) + 1000
    counts = spark.range(n).select(
        (F.col("id") % 100).alias("doc"), F.concat(F.lit("t"), "id").alias("term"), F.lit(1).cast("bigint").alias("tf")
    )
    fitted = textweights.fit_vocabulary(counts, spark.range(100).withColumnRenamed("id", "doc"), "doc")
    assert fitted.count() == n
    few = textweights.fit_vocabulary(counts, spark.range(100).withColumnRenamed("id", "doc"), "doc", size=7)
    assert few.count() == 7


@pytest.mark.parametrize("n", [0, 1, 250, 999, 1000, 2000])
def test_exact_samples_with_refined_ranges(spark, n, monkeypatch):
    monkeypatch.setattr(sampling, "_RANGE_ROWS", 1)
    monkeypatch.setattr(sampling, "_STEP_BITS", 4)
    df = spark.range(1000)
    chosen = df.filter(sampling.lowest_n(df, n, 3, "id"))
    by_hash = sorted(df.select(sampling.key_hash(3, "id"), "id").collect())
    assert sorted(r["id"] for r in chosen.collect()) == sorted(i for _, i in by_hash[:n])


def jobs_of(spark, build):
    """Spark jobs that run while a query is built."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_attached_views_run_no_job_and_counted_indexes_round_trip(spark, small):
    from impressa.sources import views

    # The footers of the three tables are read, and nothing else.
    assert jobs_of(spark, lambda: views.impressions(spark, small)) <= 3
    log = views.interactions(spark, small)
    indexes = {c: ids.dense_id_index(log, c, counted=True) for c in (ITEM, USER)}
    assert set(indexes[ITEM].columns) == {ITEM, f"{ITEM}_index", "n"}
    encoded = ids.encode_ids(log.select("row_id", *KEYS), indexes)
    again = ids.decode_ids(encoded, indexes)
    assert set(again.columns) == {"row_id", *KEYS}
    assert again.select("row_id", *KEYS).exceptAll(log.select("row_id", *KEYS)).count() == 0


# ---------------------------------------------------------------- growing indexes, co-located tables


def test_an_index_grows_and_old_numbers_stay(spark):
    first = spark.createDataFrame([("b",), ("d",), ("b",)], "u string")
    second = spark.createDataFrame([("a",), ("d",), ("c",), ("a",), (None,)], "u string")
    for counted in (True, False):
        index = ids.dense_id_index(first, "u", counted)
        grown = ids.extend_id_index(index, second, "u")
        assert grown.columns == index.columns
        found = {r["u"]: r["u_index"] for r in grown.collect()}
        assert found == {"b": 0, "d": 1, "a": 2, "c": 3}
        if counted:
            assert {r["u"]: r["n"] for r in grown.collect()} == {"b": 2, "d": 2, "a": 2, "c": 1}
        # Encoded rows read the same with both, and a batch without new ids changes no number.
        encode = lambda i: sorted(map(tuple, ids.encode_ids(first.withColumn("x", F.lit(1)), {"u": i}).collect()))
        assert encode(index) == encode(grown)
        again = {r["u"]: r["u_index"] for r in ids.extend_id_index(grown, first, "u").collect()}
        assert again == found
    empty = ids.dense_id_index(first.limit(0), "u")
    assert {r["u"]: r["u_index"] for r in ids.extend_id_index(empty, first, "u").collect()} == {"b": 0, "d": 1}


def test_bucketed_tables_join_without_exchange(spark):
    rng = random.Random(9)
    keys = ["u", "i"]
    pair = lambda: (str(rng.randrange(20)) if rng.random() < 0.97 else None, rng.randrange(9))
    tables = {m: [(*pair(), rng.random()) for _ in range(300)] for m in ("a", "b")}
    labels = [(*pair(), rng.randrange(2)) for _ in range(300)]
    frames = {m: spark.createDataFrame(t, f"u string, i int, {m} double") for m, t in tables.items()}
    marked = spark.createDataFrame(labels, "u string, i int, y int")
    predictions = colocated.write_predictions(frames, keys, 4)
    found = colocated.joined(predictions, colocated.write_labels(marked, keys, ["y"], 4))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = joins.join_labels(
        joins.join_predictions(frames, keys), marked.groupBy(*keys).agg(F.max("y").alias("y")), keys
    )
    key = lambda rows: sorted((r["u"], r["i"], round(r["a"], 9), round(r["b"], 9), r["y"]) for r in rows)
    assert key(found.collect()) == key(want.collect()) and found.count() > 20
    with pytest.raises(ValueError):
        colocated.joined(predictions, colocated.write_labels(marked, keys, ["y"], 8))


def test_numbers_of_buckets_divide_each_other():
    found = [colocated.buckets_for(n) for n in (0, 1, 10**6, 10**6 + 1, 3 * 10**6, 10**9)]
    assert found == [1, 1, 1, 2, 4, 1024] and colocated.buckets_for(0, least=4) == 4


# ---------------------------------------------------------------- draws by hash ranges


def test_draws_by_ranges_are_exact_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(bootstrap, "RANGE_ROWS", 20)
    monkeypatch.setattr(bootstrap, "DRAW_RUN", 16)
    df = spark.range(700).select(F.col("id").alias("key"), (F.col("id") * 2).alias("x"))
    sample = bootstrap.bootstrap(df, 5000, 19, "key")
    drawn = rows(sample, "draw", "key", "x")
    assert [d for d, _, _ in drawn] == list(range(5000)) and all(x == 2 * k for _, k, x in drawn)
    assert drawn == rows(bootstrap.bootstrap(df.repartition(13), 5000, 19, "key"), "draw", "key", "x")
    assert drawn != rows(bootstrap.bootstrap(df, 5000, 20, "key"), "draw", "key", "x")


def test_draws_by_ranges_are_multinomial(spark, monkeypatch):
    """Draws of each row over many samples: mean and variance of a uniform multinomial."""
    monkeypatch.setattr(bootstrap, "RANGE_ROWS", 4)
    df = spark.range(60).select(F.col("id").alias("key"))
    counts = np.zeros((12, 60))
    for seed in range(12):
        for r in bootstrap.bootstrap_keys(df, 600, seed, "key").groupBy("key").count().collect():
            counts[seed, r["key"]] = r["count"]
    assert (counts.sum(axis=1) == 600).all()
    # Chi-square of 12 x 59 degrees of freedom, five standard deviations to either side.
    statistic, freedom = ((counts - 10) ** 2 / 10).sum(), 12 * 59
    assert abs(statistic - freedom) < 5 * (2 * freedom) ** 0.5


@pytest.mark.parametrize("bits", [0, 1, 4])
def test_draws_of_ranges_add_up(spark, bits):
    sizes = spark.createDataFrame([(i, i + 1) for i in range(0, 1 << bits, 3)], "range bigint, rows bigint")
    for n in (0, 1, 977):
        found = bootstrap.range_draws(sizes, bits, n, 3).collect()
        assert len(found) == sizes.count() and sum(r["draws"] for r in found) == n


def test_draws_by_ranges_of_one_row_and_of_none(spark):
    one = spark.range(1).select(F.col("id").alias("key"))
    assert bootstrap.bootstrap(one, 40, 1, "key").count() == 40
    assert bootstrap.bootstrap(one, 0, 1, "key").count() == 0
    with pytest.raises(ValueError):
        bootstrap.bootstrap(one.limit(0), 5, 1, "key")


def test_draws_by_ranges_sort_no_rows_globally(spark):
    """Ranges are few; the rows themselves meet by hash only."""
    df = spark.range(5000).select(F.col("id").alias("key"))
    plan = bootstrap.bootstrap_keys(df, 100, 1, "key")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


# ---------------------------------------------------------------- sketches


def test_sketches_of_parts_merge_within_their_error(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.col("id") % 6).alias("part"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 9000).alias("who"),
        (F.col("id") * 7919 % 60_000).cast("double").alias("x"),
    )
    path, built = str(tmp_path / "parts"), sketches.part_sketches(df, ["part"], ["who"], ["x"])
    for part in range(6):
        sketches.store_parts(built.filter(F.col("part") == part), path, "part")
    sketches.store_parts(built.filter("part = 2"), path, "part")
    stored = sketches.read_parts(spark, path)
    assert stored.count() == 6
    found = sketches.estimates(sketches.merged(stored), [0.1, 0.5, 0.99]).first()
    exact = df.agg(F.count_distinct("who")).first()[0]
    assert found["n"] == 60_000 and abs(found["distinct_who"] - exact) < 0.04 * exact
    assert np.allclose(found["quantiles_x"], [6000, 30_000, 59_400], atol=0.012 * 60_000)
    half = sketches.estimates(sketches.merged(stored.filter("part < 3"))).first()
    assert half["n"] == 30_000


def test_sketches_of_nulls_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None)], "part int, who string, x double")
    found = sketches.estimates(sketches.part_sketches(df, ["part"], ["who"], ["x"])).first()
    assert (found["n"], found["distinct_who"], found["quantiles_x"]) == (2, 0, None)
    assert sketches.merged(sketches.part_sketches(df.limit(0), ["part"], ["who"], ["x"]), ["part"]).count() == 0


def test_normalized_weights_write_no_counts(spark, small, monkeypatch):
    def refused(df):
        raise AssertionError(f"written: {df.columns}")

    monkeypatch.setattr(textual, "materialize", refused)
    cells = textual.tfidf_normalized(spark, small)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and not [
        x for x in plan.splitlines() if "hashpartitioning(doc_id" in x and "term" in x
    ]


def test_counts_of_frequent_terms_are_not_shuffled(spark, monkeypatch):
    texts = [(i % 40, f"a b b c{i % 3} d{i}") for i in range(60)] + [(41, ""), (42, None), (None, "a z")]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(3, "doc_id")
    counts = textweights.term_counts(documents, "doc_id", text.tokens("text", text.WHITESPACE))
    vocabulary = textweights.fit_vocabulary(counts, documents, "doc_id")
    weigh = lambda: textweights.weighted_terms(counts, vocabulary, "doc_id", 3)
    whole = weigh()
    monkeypatch.setattr(textweights, "HEAD_TERMS", 4)
    split = weigh()
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert whole.count() == counts.count() > 60
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = textweights.document_vectors(weigh(), "doc_id")
        rows = textweights.document_vectors(whole, "doc_id").count()
        assert vectors.count() == rows
        plan = vectors._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # By term only what the frequent terms leave; by document each table once, and nothing after the two meet.
    by_term = [x for x in plan.splitlines() if "hashpartitioning(term" in x]
    assert len(by_term) == 2 and "LeftAnti" in plan
    assert "hashpartitioning(doc_id" not in plan.split("Union")[0]
