"""Engagement labels from timestamps, and hard decisions from scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.sources.schemas import LABELS


def engaged(timestamp: Column | str) -> Column:
    """1 where the engagement has a timestamp (0 is one), else 0."""
    column = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.when(column.isNull(), 0).otherwise(1)


def label_columns(dtype: str = "int") -> list[Column]:
    return [engaged(f"{label}_timestamp").cast(dtype).alias(label) for label in LABELS]


def with_labels(df: DataFrame, dtype: str = "int") -> DataFrame:
    """Replace the four engagement timestamps by 0/1 labels."""
    stamps = {f"{label}_timestamp" for label in LABELS}
    return df.select(*[c for c in df.columns if c not in stamps], *label_columns(dtype))


def at_least(score: Column | str, threshold: float, positive=1, negative=0) -> Column:
    """Hard decision, threshold included; a null score counts as negative."""
    column = F.col(score) if isinstance(score, str) else score
    return F.when(column >= threshold, positive).otherwise(negative)
