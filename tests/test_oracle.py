"""Every query with oracle SQL gives the rows that DuckDB gives on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from impressa.operators import joins, profiles

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

# Queries whose joins split frequent keys.
SPLITTING = [
    "class_mean_vectors",
    "decode_ids",
    "encode_ids",
    "media_category",
    "one_hot",
    "rocchio_scores",
    "tfidf_normalized",
]


@pytest.fixture(scope="module")
def duck(medium):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(medium).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def ordered(table):
    names = sorted(table.column_names)
    table = table.select(names).combine_chunks()
    return table.sort_by([(name, "ascending") for name in names])


def assert_same(ours, theirs):
    types = {f.name: str(f.type).replace("large_", "") for f in theirs.schema}
    assert {f.name: str(f.type) for f in ours.schema} == types
    assert ours.num_rows == theirs.num_rows > 0
    ours, theirs = ordered(ours), ordered(theirs)
    for name in ours.column_names:
        a, b = ours.column(name).to_pandas(), theirs.column(name).to_pandas()
        differ = ~((a == b) | (a.isna() & b.isna()))
        assert not differ.any(), f"{name}: {differ.sum()} differ, e.g. {a[differ].iloc[0]!r} {b[differ].iloc[0]!r}"


# Queries of the optional part have tests of their own.
@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(entry_points.LLM_ORACLES)))
def test_same_rows_as_duckdb(spark, duck, medium, name):
    assert_same(QUERIES[name](spark, medium).toArrow(), duck.sql(ORACLES[name]).to_arrow_table())


@pytest.mark.parametrize("name", SPLITTING)
def test_same_rows_with_split_keys(spark, duck, medium, name, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 60)
    monkeypatch.setattr(profiles, "HOT_USER_PAIRS", 45)
    assert_same(QUERIES[name](spark, medium).toArrow(), duck.sql(ORACLES[name]).to_arrow_table())


def test_oracle_covers_known_queries_only():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_the_flagship_columns(spark):
    df = entry_points.entry(spark)
    assert {"label", "model_name", "log_loss", "skipped"} < set(df.columns)
    assert df.count() == 4
