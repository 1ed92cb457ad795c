"""Reader that keeps the lines it cannot take: a table of good rows and one of bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from impressa.sources.schemas import FIELD_SEPARATOR, RAW_LOG


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType = RAW_LOG, sep: str = FIELD_SEPARATOR
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of headerless text without quoting; every line is in one of them, once.

    Good rows have the columns of ``schema``; an empty cell is null. Bad ones are (file, line, reason,
    column): ``width`` where the number of cells differs from the schema's, an empty line included, else
    ``type`` with the first column whose cell does not read as its type. Both come from one narrow scan of
    the lines, each side filtered in place; nothing is shuffled or gathered. A line is cut and read once.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("line"),
        F.split("value", "\\Q" + sep + "\\E", -1).alias("_cells"),
    )
    fits = F.size("_cells") == len(schema.fields)
    read, wrong = [], []
    for i, field in enumerate(schema.fields):
        cell = F.nullif(F.get("_cells", F.lit(i)), F.lit(""))
        value = cell.try_cast(field.dataType)
        read.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            wrong.append(F.when(cell.isNotNull() & value.isNull(), F.lit(field.name)))
    first_wrong = F.coalesce(*wrong) if wrong else F.lit(None).cast("string")
    reason = F.when(~fits, F.lit("width")).when(first_wrong.isNotNull(), F.lit("type"))
    judged = F.struct(
        "file", "line", reason.alias("reason"), F.when(fits, first_wrong).alias("column"), F.struct(*read).alias("_read")
    )
    # A generator, so that the filters below are not moved under it, where they would cut the line
    # anew for every cell that they look at.
    checked = lines.select(F.inline(F.array(judged)))
    good = checked.filter(F.col("reason").isNull()).select("_read.*")
    bad = checked.filter(F.col("reason").isNotNull()).select("file", "line", "reason", "column")
    return good, bad


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Bad lines by reason, as Parquet, beside those of earlier runs."""
    bad.write.mode("append").partitionBy("reason").parquet(path)
