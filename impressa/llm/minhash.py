"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all hash values of a document: the first spreads its shingles over a ring,
the second, shifted by one place per value, ranks the places. Documents that agree in a band of
values are candidates; chains of candidates form clusters. Within a cluster all pairs are compared
on their full shingle sets, and links make the components.

Documents with equal shingle sets are one from the start. A cluster too large for one group is compared
band by band, or cut into blocks with every pair of blocks a group of its own, whichever lays out fewer
copies: dense clusters share most bands and go by blocks, long chains go by bands at a cost that grows
with their length. Of the links in a group only a spanning forest leaves it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.llm.batches import map_texts
from impressa.llm.components import connected_components, even_share
from impressa.operators.joins import hot_keys, spread_join
from impressa.session import materialize

SHINGLE_WORDS = 5
# A pair of similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS: 0.9999998 at 0.85.
BANDS, ROWS = 40, 7
# Blocks of a cluster have about so many documents and shingles at most.
BLOCK_DOCUMENTS = 512
BLOCK_SHINGLES = 400_000
_COLUMNS_AT_ONCE = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)
_PLACES_AT_ONCE = 1024
# Words of a text are hashed from slices of about so many bytes.
_SLICE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_hashes(text: str) -> np.ndarray:
    data, parts, start = text.encode().lower(), [np.zeros(0, np.uint64)], 0
    while start < len(data):
        space = _SPACE.search(data, start + _SLICE_BYTES)
        end = space.start() if space else len(data)
        words = data[start:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts)


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than five are one shingle.

    A-Z are lower-cased; words are runs of anything but ASCII white space.
    """
    hashes = _word_hashes(text)
    if not len(hashes):
        return hashes
    size = min(SHINGLE_WORDS, len(hashes))
    count = len(hashes) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + count]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _ranks(places: np.ndarray) -> np.ndarray:
    """The second permutation of the ring of 2^32 places, in place."""
    places ^= places >> np.uint32(16)
    places *= np.uint32(0x85EBCA6B)
    places ^= places >> np.uint32(13)
    places *= np.uint32(0xC2B2AE35)
    places ^= places >> np.uint32(16)
    return places


@lru_cache(maxsize=1)
def _band_weights() -> np.ndarray:
    weights = np.random.RandomState(7).randint(0, 1 << 62, (BANDS, ROWS), np.int64)
    return weights.astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Circulant MinHash values of a non-empty shingle set.

    The first permutation gives each shingle a place on the ring; value k is the least rank of the
    places shifted by k. The ring is large enough that unrelated long texts share few places.
    """
    places = ((hashes * _ODD) >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(len(_SHIFTS), np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(places), _PLACES_AT_ONCE):
        ranks = _ranks(places[start : start + _PLACES_AT_ONCE, None] + _SHIFTS)
        np.minimum(lowest, ranks.min(axis=0), out=lowest)
    return lowest


def band_keys(values: np.ndarray) -> np.ndarray:
    """A key per band, of the band's number and its values."""
    banded = values.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    keys = (banded * _band_weights()).sum(axis=1, dtype=np.uint64)
    return ((keys ^ (keys >> np.uint64(31))) * _ODD).view(np.int64)


def sketches(documents: DataFrame) -> DataFrame:
    """(id, n_shingles, set_key, bands) of ``documents`` (id, text); no key or bands without words."""

    def prepare() -> Callable[[list[str]], dict]:
        def sketch(texts: list[str]) -> dict:
            sets = [shingles(text) for text in texts]
            return {
                "n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "bands": [band_keys(signature(s)) if len(s) else None for s in sets],
            }

        return sketch

    schema = "n_shingles bigint, set_key binary, bands array<bigint>"
    return map_texts(documents, ["id"], prepare, schema)


# ---------------------------------------------------------------- verification


def similar_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets have 100 * intersection >= percent * union, as a symmetric table."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    owner, code = owner[shared], (np.cumsum(times > 1) - 1)[code[shared]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(sets), len(sets)))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, _COLUMNS_AT_ONCE):
        start, end = np.searchsorted(code, (low, low + _COLUMNS_AT_ONCE))
        member = np.zeros((len(sets), int(code[end - 1]) - low + 1), np.float32)
        member[owner[start:end], code[start:end] - low] = 1
        common += member @ member.T
    union = sizes[:, None] + sizes[None, :] - common
    return (100 * common >= percent * union) & (union > 0)


def _forest(ids: list[int], linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between ids that connect the same rows as all of ``linked`` do."""
    unseen = set(range(len(ids)))
    while unseen:
        todo = [unseen.pop()]
        while todo:
            row = todo.pop()
            reached = unseen.intersection(np.flatnonzero(linked[row]).tolist())
            unseen -= reached
            todo.extend(reached)
            for other in reached:
                yield ids[row], ids[other]


_GROUP = ("cluster", "band", "i", "j")


def _links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sets = [shingles(text) for *_, text in rows]
        linked = similar_pairs(sets, percent)
        if rows[0][0][2] != rows[0][0][3]:  # pairs within a block have a group of their own
            block = np.array([b for _, _, b, _ in rows])
            linked &= block[:, None] != block[None, :]
        yield from _forest([i for _, i, _, _ in rows], linked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            links: list[tuple[int, int]] = []
            keys = zip(*(batch[c].to_pylist() for c in _GROUP), strict=True)
            values = (batch[c].to_pylist() for c in ("id", "block", "text"))
            for row in zip(keys, *values, strict=True):
                if group and group[0][0] != row[0]:
                    links.extend(verify(group))
                    group = []
                group.append(row)
            yield _edges(links)
        if group:
            yield _edges(list(verify(group)))

    return run


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


def _split(rows: DataFrame, weights: DataFrame, key: str, weight: str) -> DataFrame | None:
    """The hot keys of ``rows``, whose number by key ``weights`` tells."""
    total = weights.agg(F.sum(weight)).first()[0] or 0
    return hot_keys(weights, key, weight, even_share(rows.sparkSession, total))


def _candidate_links(distinct: DataFrame) -> DataFrame:
    """(a, b): each document with the least one of every band that it shares with others."""
    banded = distinct.select("id", F.explode("bands").alias("band"))
    shared = materialize(
        banded.groupBy("band").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter(F.col("n") > 1)
    )
    hot = _split(banded, shared, "band", "n")
    linked = spread_join(banded, shared.drop("n"), "band", "id", hot=hot)
    return linked.select(F.col("id").alias("a"), F.col("least").alias("b"))


def _blocks(documents: str, shingle_count: str) -> Column:
    return F.greatest(
        F.ceil(F.col(documents) / BLOCK_DOCUMENTS), F.ceil(F.col(shingle_count) / BLOCK_SHINGLES)
    ).cast("int")


def _in_blocks(members: DataFrame) -> DataFrame:
    """(id, cluster, band, block, i, j): members of a group, once for every pair of blocks of theirs."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return members.select(
        "id", "cluster", "band", block.alias("block"), other.alias("other")
    ).select(
        "id", "cluster", "band", "block", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )


def _in_groups(members: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, cluster, band, block, i, j): the rows of every group to compare.

    ``members`` is (id, cluster, n_shingles). Band 0 stands for a whole cluster. A cluster of more than
    one block goes by its bands where these lay out fewer copies; bands of equal members count once.
    """
    sizes = materialize(
        members.groupBy("cluster")
        .agg(F.count("*").alias("documents"), F.sum("n_shingles").alias("shingles"))
        .withColumn("blocks", _blocks("documents", "shingles"))
    )
    hot = _split(members, sizes, "cluster", "documents")
    sized = spread_join(members, sizes.select("cluster", "documents", "blocks"), "cluster", "id", hot=hot)
    whole = _in_blocks(sized.withColumn("band", F.lit(0).cast("bigint")))
    large = materialize(sized.filter(F.col("blocks") > 1).select("id", "cluster"))
    if large.isEmpty():
        return whole
    banded = large.join(distinct, "id").select("id", "cluster", "n_shingles", F.explode("bands").alias("band"))
    # All documents of a band are in one cluster.
    buckets = (
        banded.groupBy("band")
        .agg(
            F.min("cluster").alias("cluster"),
            F.count("*").alias("documents"),
            F.sum("n_shingles").alias("shingles"),
            F.bit_xor(F.xxhash64("id")).alias("members"),
        )
        .filter(F.col("documents") > 1)
        .groupBy("cluster", "documents", "shingles", "members")
        .agg(F.min("band").alias("band"))
        .withColumn("blocks", _blocks("documents", "shingles"))
    )
    buckets = materialize(buckets)
    copies = F.sum(F.col("documents") * F.col("blocks")).alias("copies")
    by_band = materialize(
        buckets.groupBy("cluster")
        .agg(copies)
        .join(sizes.withColumnRenamed("documents", "all"), "cluster")
        .filter(F.col("copies") < F.col("all") * F.col("blocks"))
        .select("cluster")
    )
    chosen = buckets.join(by_band, "cluster", "left_semi").select("cluster", "band", "documents", "blocks")
    hot_bands = _split(banded, chosen, "band", "documents")
    listed = spread_join(banded.drop("cluster"), chosen.drop("documents"), "band", "id", hot=hot_bands)
    return spread_join(whole, by_band, "cluster", "id", "left_anti", hot).unionByName(_in_blocks(listed))


def near_duplicates(documents: DataFrame, percent: int = 85, id_column: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``documents`` (id bigint, text).

    Documents are linked if their shingle sets overlap by ``percent`` of their union; a component is
    named by its smallest id, and that document is kept. Null and empty texts have no shingles and
    are linked with nothing. Ids should be unique; of rows that share one, each is linked by its own
    text, and all of those that name a component are kept. Rows with a null id are linked with
    nothing, have no component and are kept. An empty table gives no rows.
    """
    chosen = documents.select(F.col(id_column).alias("id"), "text")
    sketched = materialize(sketches(chosen))
    # One document for each distinct shingle set.
    distinct = materialize(
        sketched.filter(F.col("set_key").isNotNull() & F.col("id").isNotNull())
        .groupBy("set_key")
        .agg(
            F.min("id").alias("id"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )
    clusters = connected_components(_candidate_links(distinct)).withColumnsRenamed(
        {"node": "id", "component": "cluster"}
    )
    members = materialize(clusters.join(distinct.select("id", "n_shingles"), "id"))
    groups = _in_groups(members, distinct.select("id", "n_shingles", "bands"))
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Clustered documents grow with all documents: the join is a shuffled one at every size.
    placed = chosen.join(groups.hint("shuffle_hash"), "id").repartition(tasks, *_GROUP).sortWithinPartitions(*_GROUP)
    links = placed.select(*_GROUP, "id", "block", "text").mapInArrow(_links(percent), "a bigint, b bigint")
    named = connected_components(links)
    sets = distinct.join(named, F.col("id") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id")
    )
    # A set may have very many copies; what has no words or no id is linked with nothing.
    linked = F.col("set_key").isNotNull() & F.col("id").isNotNull()
    hot = _split(sketched, distinct, "set_key", "copies")
    rows = spread_join(
        sketched.filter(linked).select("id", "n_shingles", "set_key"), sets, "set_key", "id", "left", hot
    ).select("id", "n_shingles", "component_id")
    alone = sketched.filter(~linked).select("id", "n_shingles", F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return rows.union(alone).withColumn("kept", kept).withColumnRenamed("id", id_column)
