"""Context-triggered piecewise hashing, and likeness of fingerprints by edit distance.

A rolling hash over seven bytes ends a chunk wherever it hits a trigger value, so that chunk ends
depend on the text around them only. Every chunk gives one of 64 signs. A fingerprint holds the
signs at a block size that suits the text's length and at twice that size; two fingerprints are
compared where they have a block size in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from impressa.llm.batches import pieces
from impressa.llm.sharding import text_number

# Window, smallest block size, most signs at either block size, and the signs.
WINDOW = 7
SMALLEST_BLOCK = 3
MOST_SIGNS = (64, 32)
SIGNS = np.frombuffer(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8
)
_SIGN_CODES = {int(s): i for i, s in enumerate(SIGNS)}

_ROLL = np.uint32(0x01000193)
_WEIGHTS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last seven bytes up to each position."""
    spread = data.astype(np.uint32) + np.uint32(1)
    rolled = np.zeros(len(data), np.uint32)
    for back in range(WINDOW - 1, -1, -1):
        rolled *= _ROLL
        rolled[back:] += spread[: max(0, len(spread) - back)]
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x85EBCA6B)
    return rolled ^ (rolled >> np.uint32(13))


def _signs(data: np.ndarray, ends: np.ndarray, most: int) -> bytes:
    """A sign per chunk; what follows the last but one possible chunk is one chunk."""
    starts = np.concatenate(([0], ends + 1))[:most]
    starts = starts[starts < len(data)]
    if not len(starts):
        return b""
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    weighted = (data + np.uint64(1)) * _WEIGHTS[place & 4095]
    sums = np.add.reduceat(weighted, starts)
    sums = (sums ^ (sums >> np.uint64(32))) * _SPREAD
    return SIGNS[sums >> np.uint64(58)].tobytes()


def fingerprint(text: str) -> str:
    """``block:signs:signs at twice the block`` of a whole text; ``3::`` of an empty one."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{SMALLEST_BLOCK}::"
    most, least = MOST_SIGNS[0], MOST_SIGNS[0] // 2
    block = SMALLEST_BLOCK
    while block * most < len(data):
        block *= 2
    rolled, wide = _rolling(data), data.astype(np.uint64)
    while True:
        ends = np.flatnonzero(rolled % np.uint32(block) == block - 1)
        if len(ends) + 1 >= least or block == SMALLEST_BLOCK:
            break
        block //= 2
    double = ends[rolled[ends] % np.uint32(2 * block) == 2 * block - 1]
    fine, coarse = _signs(wide, ends, most), _signs(wide, double, MOST_SIGNS[1])
    return f"{block}:{fine.decode()}:{coarse.decode()}"


def _codes(signs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in signs])
    padded = b"".join(s.ljust(64, b"\0") for s in signs)
    return np.frombuffer(padded, np.uint8).reshape(-1, 64), lengths


def edit_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Levenshtein distances of pairs of strings of at most 64 bytes without zero bytes.

    A column of the distance table is two bit vectors, of its steps up and down; all pairs advance
    by a column at once.
    """
    a, length_a = _codes(left)
    b, length_b = _codes(right)
    one, zero = np.uint64(1), np.uint64(0)
    up = np.full(len(left), ~zero)
    down = np.zeros(len(left), np.uint64)
    last = one << np.maximum(length_a - 1, 0).astype(np.uint64)
    distance = length_a.copy()
    for column in range(int(length_b.max(initial=0))):
        live = column < length_b
        same = np.packbits(a == b[:, column, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        plus, minus = down | ~(horizontal | up), up & horizontal
        distance += np.where(live, ((plus & last) != 0).astype(int) - ((minus & last) != 0), 0)
        plus, minus = (plus << one) | one, minus << one
        up = np.where(live, minus | ~(vertical | plus), up)
        down = np.where(live, plus & vertical, down)
    return np.where(length_a == 0, length_b, distance)


def likenesses(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness from 0 to 1 of pairs of fingerprints.

    1 minus the edit distance over the longer length, at the block size in common, the better one
    if there are two; 0 without one. Equal fingerprints have 1.
    """
    best = np.zeros(len(left))
    pairs: list[tuple[int, bytes, bytes]] = []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b:
            best[i] = 1.0
            continue
        block_a, *signs_a = a.encode().split(b":")
        block_b, *signs_b = b.encode().split(b":")
        at = {int(block_a) << k: s for k, s in enumerate(signs_a)}
        for k, signs in enumerate(signs_b):
            other = at.get(int(block_b) << k)
            if other and signs:
                pairs.append((i, other, signs))
    if pairs:
        at, a, b = (list(x) for x in zip(*pairs, strict=True))
        longer = np.maximum([len(s) for s in a], [len(s) for s in b])
        np.maximum.at(best, at, 1.0 - edit_distances(a, b) / longer)
    return best


# ---------------------------------------------------------------- operator

# Ranges of ids for each shuffle partition, so that their hashes fill partitions evenly.
_RANGES_A_PARTITION = 4
_SCHEMA = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _ranged(documents: DataFrame, number: str, ranges: int) -> DataFrame:
    """Add ``_of``, which grows with ``number``.

    Cut points are approximate quantiles: their number is fixed and any cut points will do.
    """
    places = [i / ranges for i in range(1, ranges)]
    cuts = documents.agg(F.percentile_approx(number, places, 10_000)).first()[0]
    splits = [float("-inf"), *sorted(set(cuts or [0.0])), float("inf")]
    return Bucketizer(splits=splits, inputCol=number, outputCol="_of").transform(documents)


def _with_ranges(documents: DataFrame, ranges: int) -> DataFrame:
    """Add ``_range``, which grows with the id, and ``_number``, by which a range is found.

    Rows without an id have ranges of their own below, which fall as the first bytes of the text rise.
    """
    with_id = documents.filter(F.col("id").isNotNull()).withColumn("_number", F.col("id").cast("double"))
    start = F.coalesce(text_number(F.col("text")), F.lit(-1.0))
    without = documents.filter(F.col("id").isNull()).withColumn("_number", start)
    placed = _ranged(with_id, "_number", ranges).withColumn("_range", F.col("_of").cast("int"))
    if without.isEmpty():
        return placed.drop("_of")
    below = _ranged(without, "_number", ranges).withColumn("_range", (-1 - F.col("_of")).cast("int"))
    return placed.unionByName(below).drop("_of")


def _beside_next(documents: DataFrame) -> DataFrame:
    """Rows by range in descending id, each range followed by the first rows of the next one.

    (id, text, _range, _guest): guests are those copies. Only the first id of each range, or the
    start of the first text where there is no id, is looked at across ranges; texts are shuffled once.
    """
    spark = documents.sparkSession
    partitions = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = _with_ranges(documents, partitions * _RANGES_A_PARTITION)
    # The first row has the highest id or, without ids, the lowest start of a text.
    heads = ranged.groupBy("_range").agg(F.max("id").alias("_head"), F.min("_number").alias("_start"))
    up = Window.orderBy("_range")
    lowest = F.min("_range").over(Window.partitionBy())
    heads = heads.select(
        "_range", "_head", "_start", F.coalesce(F.lead("_range").over(up), lowest).alias("_goes_to")
    )
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_goes_to").alias("range"), F.lit(True).alias("guest"))
    starts = F.col("_head").isNull() & (F.col("_number") == F.col("_start"))
    is_head = F.coalesce(F.col("id") == F.col("_head"), starts)
    places = F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own)))
    return (
        ranged.join(F.broadcast(heads), "_range")
        .select("id", "text", places.alias("_place"))
        .select("id", "text", F.col("_place.range").alias("_range"), F.col("_place.guest").alias("_guest"))
        .repartition(partitions, "_range")
        .sortWithinPartitions("_range", "_guest", F.desc_nulls_last("id"), "text")
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of rows and of their edited texts; each row is held back until the next comes."""
    held: tuple | None = None
    for batch in batches:
        for piece in pieces(batch):
            columns = [piece[c].to_pylist() for c in ("id", "_range", "_guest", "text")]
            rows = [
                (i, r, g, t or "", fingerprint(t or "")) for i, r, g, t in zip(*columns, strict=True)
            ]
            before = [held, *rows] if held else rows
            held = rows[-1]
            # The rows after a range's first guest are only copies of it.
            pairs = [
                (a, b) for a, b in zip(before, before[1:], strict=False) if a[1] == b[1] and not a[2]
            ]
            if pairs:
                yield _compared(pairs, piece.schema.field("id").type)


def _compared(pairs: list[tuple[tuple, tuple]], id_type: pa.DataType) -> pa.RecordBatch:
    texts = [(row[3], after[3]) for row, after in pairs]
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in texts]
    prints = [row[4] for row, _ in pairs]
    edited_prints = [fingerprint(e) for e in edited]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row, _ in pairs], id_type),
            pa.array([len(t) for t, _ in texts], pa.int64()),
            pa.array([sha256(e.encode()).hexdigest() for e in edited]),
            pa.array(prints),
            pa.array(edited_prints),
            pa.array(likenesses(prints, edited_prints)),
            pa.array(likenesses(prints, [after[4] for _, after in pairs])),
        ],
        names=["id", *(part.split()[0] for part in _SCHEMA.split(", "))],
    )


def compare_with_next(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Fingerprints of every text, of its edited text, and likenesses, one row per document.

    The next document is that of the next smaller id; after the last comes the first. Nulls are
    empty texts. Rows with equal ids follow each other in text order, null ids come last; a single
    row is its own next. An empty table gives no rows. The edited text has the last half of the
    code points replaced by the first as many, or all, of the next document.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    chosen = documents.select(documents[id_column].alias("id"), "text")
    compared = _beside_next(chosen).mapInArrow(_compare, f"id {kind}, {_SCHEMA}")
    return compared.withColumnRenamed("id", id_column)


def fingerprints(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, fingerprint) of every whole text; null is an empty text."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t or "") for t in batch["text"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["id"], prints], names=["id", "fingerprint"])

    chosen = documents.select(documents[id_column].alias("id"), "text")
    return chosen.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_column)
