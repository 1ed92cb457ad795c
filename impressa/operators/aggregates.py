"""Score normalisation, histograms, class means and simple statistics."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_expr(x: Column, low: Column, high: Column) -> Column:
    """Map low..high to 0..1 without clipping; a constant column becomes 0.5."""
    return F.coalesce((x - low) / F.nullif(high - low, F.lit(0.0)), F.when(x.isNotNull(), 0.5))


def minmax_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with ``<column>_min`` and ``<column>_max``, the fitted scaler."""
    return df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}_min") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"{c}_max") for c in columns],
    )


def minmax_scale(df: DataFrame, columns: list[str], bounds: DataFrame) -> DataFrame:
    """Columns scaled with fitted bounds, which may come from other rows."""
    return df.withColumns(
        {
            c: minmax_expr(
                F.col(c).cast("double"),
                bounds.select(f"{c}_min").scalar(),
                bounds.select(f"{c}_max").scalar(),
            )
            for c in columns
        }
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max: (bin, low, n); empty bins are absent."""
    bounds = minmax_bounds(df, [column])
    low, high = bounds.select(f"{column}_min").scalar(), bounds.select(f"{column}_max").scalar()
    position = minmax_expr(F.col(column).cast("double"), low, high) * bins
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.least(F.floor(position), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return counts.select("bin", (low + F.col("bin") * (high - low) / bins).alias("low"), "n")


def mean_vectors(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Average of a vector column per key, with partial sums before the shuffle."""
    return df.groupBy(*keys).agg(
        Summarizer.mean(F.col(vector)).alias("mean"), F.count("*").alias("n")
    )


def rmse(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    error = F.col(truth) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
