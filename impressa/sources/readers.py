"""Readers for delimited logs, id lists, indexes, predictions, labels and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from impressa.functions.text import positive_probability
from impressa.sources import schemas
from impressa.sources.schemas import FIELD_SEPARATOR, ITEM, KEYS, USER


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 24-column log. Quoting is off: a leading quote is part of the text."""
    return spark.read.csv(path, schema=schemas.RAW_LOG, sep=FIELD_SEPARATOR, header=False, quote="")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = FIELD_SEPARATOR,
    header: bool = True,
) -> DataFrame:
    """Columns of ``schema`` out of a delimited file; with a header they are found by name.

    Values are read as text and cast, so that a bad one becomes null. Files with the log's
    separator have no quoting.
    """
    quote = "" if sep == FIELD_SEPARATOR else '"'
    if not header:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = spark.read.csv(path, schema=text, sep=sep, header=False, quote=quote)
    else:
        df = spark.read.csv(path, sep=sep, header=True, quote=quote)
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_indexed_interactions(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.INDEXED_INTERACTIONS)


def read_id_list(spark: SparkSession, path: str, id_column: str) -> DataFrame:
    return spark.read.csv(path, schema=f"{id_column} string", header=False)


def read_id_index(spark: SparkSession, path: str, id_column: str) -> DataFrame:
    return read_delimited(spark, path, schemas.id_index(id_column))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.RATINGS, sep=",")


def read_predictions(
    spark: SparkSession,
    paths: Mapping[str, str],
    separators: Mapping[str, str] | None = None,
    headerless: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """One table (user, item, <model name>) per model.

    ``headerless`` gives the column order of files written without a header; the others must
    name the columns engaging_user_id, tweet_id and prediction.
    """
    separators, headerless = separators or {}, headerless or {}
    tables = {}
    for model, path in paths.items():
        schema = headerless.get(model, schemas.PREDICTIONS)
        missing = set(schemas.PREDICTIONS.names) - set(schema.names)
        if missing:
            raise ValueError(f"schema of {model} has no column {', '.join(sorted(missing))}")
        df = read_delimited(
            spark, path, schema, sep=separators.get(model, ","), header=model not in headerless
        )
        tables[model] = df.select(*KEYS, F.col("prediction").cast("double").alias(model))
    return tables


def read_class_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(item, user, positive_probability, prediction) of written class predictions.

    Columns are found by name, so a leading row number does not matter.
    """
    df = read_delimited(spark, path, schemas.PRINTED_PREDICTIONS, sep=",")
    p = positive_probability("probability")
    return df.select(ITEM, USER, p.alias("positive_probability"), "prediction")


def read_labels(spark: SparkSession, path: str, label: str) -> DataFrame:
    """(user, item, label) with the chosen engagement as byte column ``label``."""
    schema = schemas.struct(f"engaging_user_id string, tweet_id string, {label} tinyint")
    return read_delimited(spark, path, schema).withColumnRenamed(label, "label")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_log_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    """Convert a delimited log once, so that later scans prune columns and push filters."""
    read_raw_log(spark, source).write.mode("overwrite").option("compression", "zstd").parquet(target)


def load_or_fit(load: Callable[[str], object], path: str, fit: Callable[[], object]):
    """A saved model if ``path`` holds one, else a new one, saved there."""
    try:
        return load(path)
    except (Py4JJavaError, AnalysisException) as error:
        if "does not exist" not in str(error) and "PATH_NOT_FOUND" not in str(error):
            raise
    model = fit()
    model.write().overwrite().save(path)
    return model
