"""Readers and writers: formats, bad values, round trips."""

from pathlib import Path

import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from impressa.functions.labels import with_labels
from impressa.models.recommend import fit_explicit
from impressa.session import discard, materialize, scratch_dir, scratch_path
from impressa.sources import onefile, quarantine, readers, schemas, views, writers
from impressa.sources.schemas import FIELD_SEPARATOR, ITEM, USER


def line(**values):
    return FIELD_SEPARATOR.join(str(values.get(name, "")) for name in schemas.RAW_LOG.names)


@pytest.fixture
def log_file(tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text(
        "\n".join(
            [
                line(text_tokens='"101\t56', tweet_id="A", engaging_user_id="U", like_timestamp=0, language="en"),
                line(
                    text_tokens="7",
                    tweet_id="B",
                    engaging_user_id="V",
                    engaging_user_is_verified="TRUE",
                    engaging_user_follower_count="bad",
                    reply_timestamp=5,
                ),
            ]
        )
        + "\n"
    )
    return str(path)


def test_raw_log_keeps_quotes_and_nulls_bad_values(spark, log_file):
    first, second = readers.read_raw_log(spark, log_file).orderBy(ITEM).collect()
    assert len(first) == 24
    assert first["text_tokens"] == '"101\t56' and first["language"] == "en" and first["hashtags"] is None
    assert first["like_timestamp"] == 0 and first["reply_timestamp"] is None
    assert second["engaging_user_is_verified"] is True and second["engaging_user_follower_count"] is None
    labelled = with_labels(readers.read_raw_log(spark, log_file)).orderBy(ITEM).collect()
    assert [r["like"] for r in labelled] == [1, 0] and [r["reply"] for r in labelled] == [0, 1]


def test_raw_log_to_parquet(spark, log_file, tmp_path):
    readers.raw_log_to_parquet(spark, log_file, str(tmp_path / "log.parquet"))
    stored = spark.read.parquet(str(tmp_path / "log.parquet"))
    assert stored.schema == schemas.RAW_LOG
    assert stored.exceptAll(readers.read_raw_log(spark, log_file)).count() == 0


def test_whole_log_round_trip(spark, small, tmp_path):
    log = views.impressions(spark, small)
    path = str(tmp_path / "log")
    writers.write_sample(log, path, row_id="row_id")
    back = readers.read_raw_log(spark, path)
    wanted = log.drop("row_id")
    assert back.count() == wanted.count() == 1000
    assert back.exceptAll(wanted).count() == 0


def test_log_view_equals_the_log_schema(spark, small):
    log = views.impressions(spark, small).drop("row_id")
    assert [(f.name, f.dataType) for f in log.schema] == [(f.name, f.dataType) for f in schemas.RAW_LOG]


def test_indexed_interactions_round_trip(spark, tmp_path):
    schema = schemas.INDEXED_INTERACTIONS
    df = spark.createDataFrame([(1, 2, 1, 0, 0, 1), (3, 4, 0, 0, 0, 0)], schema)
    path = str(tmp_path / "indexed")
    writers.write_delimited(df, path, single_file=True)
    assert len(list((tmp_path / "indexed").glob("part-*"))) == 1
    back = readers.read_indexed_interactions(spark, path)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == 0


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "labels.tsv"
    path.write_text("like\x01tweet_id\x01extra\x01engaging_user_id\n1\x01T\x01x\x01U\n0\x01S\x01x\x01V\n")
    labels = readers.read_labels(spark, str(path), "like")
    assert labels.dtypes == [(USER, "string"), (ITEM, "string"), ("label", "tinyint")]
    assert sorted(map(tuple, labels.collect())) == [("U", "T", 1), ("V", "S", 0)]
    with pytest.raises(ValueError, match="reply"):
        readers.read_labels(spark, str(path), "reply")


def test_predictions_of_several_formats(spark, tmp_path):
    (tmp_path / "mf").write_text("tweet_id\x01engaging_user_id\x01prediction\nT\x01U\x010.25\n")
    (tmp_path / "nncf").write_text("U,T,0.5\nV,S,oops\n")
    tables = readers.read_predictions(
        spark,
        {"mf": str(tmp_path / "mf"), "nncf": str(tmp_path / "nncf")},
        separators={"mf": FIELD_SEPARATOR},
        headerless={"nncf": schemas.PREDICTIONS},
    )
    assert tables["mf"].collect() == [("U", "T", 0.25)]
    assert sorted(map(tuple, tables["nncf"].collect())) == [("U", "T", 0.5), ("V", "S", None)]
    with pytest.raises(ValueError, match="prediction"):
        readers.read_predictions(
            spark, {"x": str(tmp_path / "nncf")}, headerless={"x": schemas.id_index(USER)}
        )


def test_id_lists_indexes_and_ratings(spark, tmp_path):
    (tmp_path / "ids").write_text("A\nB\n")
    assert sorted(r[0] for r in readers.read_id_list(spark, str(tmp_path / "ids"), USER).collect()) == ["A", "B"]
    (tmp_path / "index").write_text("tweet_id\x01tweet_id_index\nA\x010\nB\x013000000000\n")
    index = readers.read_id_index(spark, str(tmp_path / "index"), ITEM)
    assert sorted(map(tuple, index.collect())) == [("A", 0), ("B", 3000000000)]
    (tmp_path / "ratings").write_text("userId,movieId,rating,timestamp\n1,2,3.5,964982703\n")
    assert readers.read_ratings(spark, str(tmp_path / "ratings")).collect() == [(1, 2, 3.5, 964982703)]


def test_lines_and_result_tables(spark, tmp_path):
    df = spark.createDataFrame([("u", 0.12345, 1)], "a string, `areaUnderPR-0.1` double, n int")
    writers.write_lines(df, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).collect() == [("u,0.12345,1",)]
    writers.write_result_table(df, str(tmp_path / "table"))
    [part] = (tmp_path / "table").glob("part-*")
    assert part.read_text() == "a,areaUnderPR-0.1,n\nu,0.123,1\n"


def test_submission_has_no_header(spark, tmp_path):
    df = spark.createDataFrame([("U", "T", 1.0, "x")], f"{USER} string, {ITEM} string, prediction double, o string")
    writers.write_submission(df, str(tmp_path / "out"))
    written = "".join(part.read_text() for part in (tmp_path / "out").glob("part-*"))
    assert written == "T,U,1.0\n"


def test_load_or_fit_reuses_a_saved_model(spark, tmp_path):
    ratings = spark.createDataFrame([(u, i, float(u + i)) for u in range(4) for i in range(5)], "u int, i int, r double")
    path, fits = str(tmp_path / "model"), []

    def fit():
        fits.append(1)
        return fit_explicit(ratings, "u", "i", "r")

    first = readers.load_or_fit(ALSModel.load, path, fit)
    second = readers.load_or_fit(ALSModel.load, path, fit)
    assert len(fits) == 1
    assert second.itemFactors.exceptAll(first.itemFactors).count() == 0


def test_materialize_writes_under_the_configured_folder(spark):
    df = materialize(spark.range(10).withColumn("id2", F.col("id") * 2))
    [path] = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    assert scratch_dir(spark) in path and df.count() == 10
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class _Session:
    """The parts of a session that the choice of the folder looks at."""

    class _Conf:
        def __init__(self, settings):
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    def __init__(self, **settings):
        self.conf = self._Conf({k.replace("__", "."): v for k, v in settings.items()})


def test_scratch_folder_without_a_setting_lies_in_the_warehouse():
    shared = _Session(spark__sql__warehouse__dir="hdfs://nn/warehouse/")
    assert scratch_dir(shared) == "hdfs://nn/warehouse/_scratch"
    both = _Session(spark__sql__warehouse__dir="hdfs://nn/w", spark__checkpoint__dir="hdfs://nn/c")
    assert scratch_dir(both) == "hdfs://nn/c"


def test_discard_deletes_a_table(spark):
    path = scratch_path(spark)
    spark.range(3).write.parquet(path)
    discard(spark, path)
    assert not Path(path).exists()


# ---------------------------------------------------------------- quarantine


def test_every_line_is_good_or_bad(spark, tmp_path):
    path = tmp_path / "log.tsv"
    lines = [
        line(text_tokens='"a', tweet_id="A", engaging_user_is_verified="true", like_timestamp=3),
        line(tweet_id="B", engaging_user_follower_count="many", reply_timestamp="never"),
        line(tweet_id="C")[:-1],
        line(tweet_id="D") + FIELD_SEPARATOR,
        "",
        line(),
        line(tweet_id="A", like_timestamp="12345678901234567890"),
    ]
    path.write_text("\n".join(lines) + "\n")
    good, bad = quarantine.read_checked(spark, str(path))
    assert good.schema == schemas.RAW_LOG and good.count() + bad.count() == len(lines)
    kept = {r[ITEM]: r for r in good.collect()}
    assert set(kept) == {"A", None} and kept["A"]["text_tokens"] == '"a' and kept["A"]["like_timestamp"] == 3
    told = sorted((r["line"], r["reason"], r["column"]) for r in bad.collect())
    assert told == sorted(
        [
            (lines[1], "type", "engaging_user_follower_count"),
            (lines[2], "width", None),
            (lines[3], "width", None),
            (lines[4], "width", None),
            (lines[6], "type", "like_timestamp"),
        ]
    )
    assert all(r["file"].endswith("log.tsv") for r in bad.collect())


def test_good_lines_are_those_of_the_plain_reader(spark, small, tmp_path):
    path = str(tmp_path / "log")
    writers.write_sample(views.impressions(spark, small), path, row_id="row_id")
    good, bad = quarantine.read_checked(spark, path)
    plain = readers.read_raw_log(spark, path)
    assert bad.count() == 0
    assert good.exceptAll(plain).count() == plain.exceptAll(good).count() == 0


def test_quarantine_keeps_earlier_runs(spark, tmp_path):
    path, kept = tmp_path / "ids.txt", str(tmp_path / "bad")
    path.write_text("1,2\nx,2\n1\n")
    schema = schemas.struct("a int, b int")
    for _ in range(2):
        good, bad = quarantine.read_checked(spark, str(path), schema, ",")
        quarantine.write_quarantine(bad, kept)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert sorted(r["reason"] for r in spark.read.parquet(kept).collect()) == ["type", "type", "width", "width"]


# ---------------------------------------------------------------- one file


@pytest.mark.parametrize("header", [True, False])
def test_parts_become_one_file_in_order(spark, tmp_path, header):
    path = tmp_path / "rows.csv"
    df = spark.range(2000, numPartitions=7).select("id", F.concat(F.lit("é"), F.col("id")).alias("name"))
    for _ in range(2):
        onefile.write_one_file(df, str(path), sep=",", header=header)
    expected = (["id,name"] if header else []) + [f"{i},é{i}" for i in range(2000)]
    assert path.read_text().splitlines() == expected
    assert [p.name for p in tmp_path.iterdir()] == ["rows.csv"]
    assert spark.read.csv(str(path), header=header).count() == 2000


def test_one_file_of_no_rows(spark, tmp_path):
    empty = spark.range(0).select("id", F.lit("x").alias("name"))
    onefile.write_one_file(empty, str(tmp_path / "named.csv"), sep=",")
    onefile.write_one_file(empty, str(tmp_path / "bare.csv"), sep=",", header=False)
    assert (tmp_path / "named.csv").read_text() == "id,name\n"
    assert (tmp_path / "bare.csv").read_text() == ""


def test_compressed_log_reads_as_the_plain_one(spark, small, tmp_path):
    log = views.impressions(spark, small, spread=True)
    writers.write_sample(log, f"{tmp_path}/packed", row_id="row_id", compression="gzip")
    writers.write_sample(log, f"{tmp_path}/plain", row_id="row_id")
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("part-*")) for n in ("packed", "plain")}
    assert size["packed"] < size["plain"] / 2
    packed, plain = (readers.read_raw_log(spark, f"{tmp_path}/{n}") for n in ("packed", "plain"))
    assert plain.count() > 0 and packed.exceptAll(plain).count() == plain.exceptAll(packed).count() == 0


def test_impressions_meet_their_texts_last(spark, small):
    """Rows are narrow where they are shuffled for their users."""
    plan = views.impressions(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and "tweet_id" in joins[0] and "engaging_user_id" in joins[1]


def test_checked_lines_are_cut_once(spark, tmp_path):
    path = f"{tmp_path}/log"
    spark.createDataFrame([("a\x01b",)], "value string").write.text(path)
    for part in quarantine.read_checked(spark, path):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "split(" in line]
