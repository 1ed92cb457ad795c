"""Token lists, categories from lists, and text lines, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAB = "\t"
WHITESPACE = r"\s+"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def tokens(column: Column | str, pattern: str = TAB) -> Column:
    """Lower-cased tokens without empty ones; null in, null out."""
    return F.array_remove(F.split(F.lower(_col(column)), pattern), "")


def list_items(column: Column | str, separator: str = TAB) -> Column:
    """Items of a delimited list as they are; null stays null."""
    return F.split(_col(column), separator)


def list_category(column: Column | str) -> Column:
    """A token list as one category value, e.g. ``[photo, photo]``."""
    return F.concat(F.lit("["), F.array_join(_col(column), ", "), F.lit("]"))


def csv_line(*columns: Column | str) -> Column:
    """Values of a row joined by commas."""
    return F.concat_ws(",", *[_col(c).cast("string") for c in columns])


def positive_probability(printed: Column | str) -> Column:
    """P(1) out of a printed probability vector ``[p0,p1]``."""
    inner = F.regexp_replace(_col(printed), r"[\[\]]", "")
    return F.get(F.split(inner, ","), 1).try_cast("double")
