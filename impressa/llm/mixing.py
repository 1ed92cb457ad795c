"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key. Documents are range-sorted by (source, key), running totals
of their sizes are added up across partitions, and each source is cut at its exact budget; a budget
above the size of the source starts another epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.functions.hashing import key_hash
from impressa.operators.ordering import number_rows, running_totals
from impressa.session import materialize

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most_epochs: int
) -> DataFrame:
    """(source, source_size, start, target) for a table (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times the
    total size by weight. A target stops at ``most_epochs`` times its source's size; the excess is
    shared again by weight until no target is above. ``start`` is the size of all earlier sources.
    Sources are numbered and added up over range partitions, so their number is not limited.
    A source without words, and a table without rows, gets target 0.
    """
    order = F.asc_nulls_last("source")
    numbered = number_rows(sizes, [order], "source_rank")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("source_rank") % len(weights) + 1).cast("int"),
    )
    limits = numbered.select(
        "*", weight.alias("weight"), (F.col("source_size") * float(most_epochs)).alias("limit")
    )
    started = running_totals(limits, ["source_rank"], ["source_size"]).withColumn(
        "start", F.col("cum_source_size") - F.col("source_size")
    )
    # Shared by weight, sources reach their limit in order of limit / weight. The level is the share
    # per weight left for those from the first one that stays below its limit.
    ranked = running_totals(
        started.withColumn("full_at", F.col("limit") / F.col("weight")),
        ["full_at", "source_rank"],
        ["limit", "weight"],
    )
    ranked = materialize(ranked)
    whole = ranked.agg(
        (F.sum("source_size") * share).alias("total"), F.sum("weight").alias("weights")
    )
    left = ranked.join(F.broadcast(whole)).select(
        "full_at",
        "source_rank",
        (F.col("total") - F.col("cum_limit") + F.col("limit")).alias("rest"),
        (F.col("weights") - F.col("cum_weight") + F.col("weight")).alias("rest_weight"),
    )
    level = left.filter(F.col("rest") <= F.col("full_at") * F.col("rest_weight")).agg(
        F.min(F.struct("full_at", "source_rank", "rest", "rest_weight")).alias("level")
    )
    shared = F.col("weight") * F.col("level.rest") / F.col("level.rest_weight")
    return ranked.join(F.broadcast(level)).select(
        "source",
        "source_size",
        "start",
        F.coalesce(F.least(F.col("limit"), shared), F.col("limit")).alias("target"),
    )


def mix(
    documents: DataFrame,
    size: Column,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most_epochs: int = 2,
    seed: int = 17,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) and ``keys`` for every row of ``documents``.

    ``taken`` words of a document are in the mix: all of them once per whole epoch, and in the last
    epoch those that lie before the budget's end in the source's random order. So each source takes
    its target, rounded to a word, and only one document of a source is taken in part. The order
    follows a hash of the doc_id and nothing physical; rows with the same doc_id follow each other
    by size and then by ``keys``, columns that tell rows apart. A null doc_id is hashed as an empty
    string, a null source is a source of its own, and documents without words take nothing. Columns other
    than doc_id, source and ``keys`` may have any name.
    """
    # Written, so that sampling the ranges and sorting do not read the texts twice.
    keyed = materialize(
        documents.select(
            "doc_id", "source", size.cast("bigint").alias("size"),
            key_hash(seed, F.col("doc_id")).alias("_key"), *keys,
        )
    )
    order = [F.asc_nulls_last("source"), "_key", F.asc_nulls_first("doc_id"), "size", *keys]
    placed = running_totals(keyed, order, ["size"])
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, most_epochs))
    joined = placed.alias("d").join(
        targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))
    )
    before = F.col("cum_size") - F.col("size") - F.col("start")
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return joined.select(
        "doc_id",
        F.col("d.source").alias("source"),
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + part).cast("bigint").alias("taken"),
        *keys,
    )


def first_words(text: Column, words: Column) -> Column:
    """``text`` up to the end of its ``words``-th word, spacing kept."""
    pieces = F.split(text, _WORD_END, -1)
    return F.array_join(F.slice(pieces, 1, words.cast("int")), "")


def _new_names(documents: DataFrame, *wanted: str) -> list[str]:
    """The names, with as many underscores before them as no column of ``documents`` has."""
    before = "_"
    while any(c.startswith(before) for c in documents.columns):
        before += "_"
    return [f"{before}{name}" for name in wanted]


def keyed_rows(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """``documents`` with two columns that tell all rows apart, and their names.

    Rows of files are named by their file and their place in it, which costs nothing. Other rows are
    numbered and written, so that a second look gives the same numbers.
    """
    names = _new_names(documents, "file", "place")
    try:
        place = documents.metadataColumn("_metadata")
        keys = [F.xxhash64(place["file_path"]).alias(names[0]), place["row_index"].alias(names[1])]
        return documents.select("*", *keys), names
    except AnalysisException:
        numbers = {names[0]: F.lit(0).cast("bigint"), names[1]: F.monotonically_increasing_id()}
        return materialize(documents.withColumns(numbers)), names


def mixed_copies(documents: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: a row of ``documents`` per copy taken, the last one cut where the budget ends.

    ``options`` go to :func:`mix`. Every row is taken by its own share, whatever it has in common with
    others: repeated rows, rows that share an id and rows without one each count, so that the words of
    each source are its target to the word. Documents of which nothing is taken are left out. Copies are
    equal rows but for the cut one.
    """
    keyed, keys = keyed_rows(documents)
    own, wanted, left = _new_names(documents, "size", "taken", "words")
    shares = mix(keyed, size, keys=keys, **options).filter(F.col("taken") > 0)
    shares = shares.select(*keys, F.col("size").alias(own), F.col("taken").alias(wanted))
    copy = F.sequence(F.lit(0), F.ceil(F.col(wanted) / F.col(own)) - 1)
    words = F.transform(copy, lambda i: F.least(F.col(own), F.col(wanted) - i * F.col(own)))
    copies = keyed.join(shares, keys).withColumn(left, F.explode(words))
    text = F.when(F.col(left) == F.col(own), F.col("text")).otherwise(first_words(F.col("text"), F.col(left)))
    return copies.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in documents.columns])
