"""Writers for logs, predictions, submissions and result tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.functions.text import csv_line
from impressa.sources.schemas import FIELD_SEPARATOR, ITEM, USER


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = FIELD_SEPARATOR,
    header: bool = True,
    single_file: bool = False,
    compression: str = "none",
) -> None:
    """Delimited text, one file per task unless a single file is asked for (small results only).

    Quoting is off with the log separator, as in the log itself. Readers tell ``compression`` by the names.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("sep", sep).option("header", header)
    writer = writer.option("compression", compression)
    if sep == FIELD_SEPARATOR:
        writer = writer.option("quote", "").option("emptyValue", "")
    writer.csv(path)


def write_sample(
    df: DataFrame, path: str, row_id: str = "id", single_file: bool = False, compression: str = "none"
) -> None:
    """A sampled log without header and without its row number."""
    write_delimited(df.drop(row_id), path, header=False, single_file=single_file, compression=compression)


def class_predictions(predictions: DataFrame) -> DataFrame:
    """(item, user, P(0), P(1), class) of a classifier's output, with plain columns."""
    p = vector_to_array("probability")
    return predictions.select(
        ITEM,
        USER,
        p[0].alias("negative_probability"),
        p[1].alias("positive_probability"),
        "prediction",
    )


def printed_predictions(predictions: DataFrame) -> DataFrame:
    """Class predictions with the probability vector printed as ``[p0,p1]``."""
    p = vector_to_array("probability")
    printed = F.concat(F.lit("["), F.concat_ws(",", p.cast("array<string>")), F.lit("]"))
    return predictions.select(ITEM, USER, printed.alias("probability"), "prediction")


def write_predictions(predictions: DataFrame, path: str) -> None:
    printed_predictions(predictions).write.mode("overwrite").csv(path, header=True)


def submission(predictions: DataFrame, score: str = "prediction") -> DataFrame:
    return predictions.select(ITEM, USER, F.col(score))


def write_submission(predictions: DataFrame, path: str, score: str = "prediction") -> None:
    submission(predictions, score).write.mode("overwrite").csv(path, header=False)


def write_by_label(predictions: DataFrame, path: str, score: str = "prediction") -> None:
    """(item, user, score) as delimited text, one folder per value of ``engagement``."""
    columns = [ITEM, USER, score, "engagement"]
    writer = predictions.select(*columns).write.mode("overwrite").partitionBy("engagement")
    writer.csv(path, sep=FIELD_SEPARATOR, header=True, quote="", emptyValue="")


def write_lines(df: DataFrame, path: str) -> None:
    """One comma-joined text line per row."""
    df.select(csv_line(*[F.col(f"`{c}`") for c in df.columns]).alias("value")).write.mode("overwrite").text(path)


def rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    """Double columns rounded, for result tables."""
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), digits).alias(name) if dtype == "double" else F.col(f"`{name}`")
            for name, dtype in df.dtypes
        ]
    )


def write_result_table(df: DataFrame, path: str, digits: int = 3) -> None:
    """Evaluation or coefficient table, a handful of rows, as one CSV file."""
    write_delimited(rounded(df, digits), path, sep=",", single_file=True)
