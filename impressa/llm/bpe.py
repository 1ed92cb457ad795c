"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

The tree's leaves are byte positions; a leaf holds the rank of the pair that starts there, and each
inner node the leftmost smallest rank below it. The root names the next merge. A merge changes
three leaves: the merged pair's, that of the neighbour before it, and that of the swallowed symbol,
each in logarithmic time. Live neighbours are linked lists.

Short pieces are merged side by side, one tree a row of a matrix; long ones one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Sequence
from functools import cached_property, lru_cache
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from impressa.llm.batches import map_texts

# Pieces up to this many bytes are merged side by side.
_SHORT = 64
_SIDE_BY_SIDE = 1 << 12
_NONE = np.int64(1) << 62
_ID_BITS = 24
# Encodings of distinct pieces kept by a worker; beyond it the store starts afresh.
_KEPT_PIECES = 300_000


class Vocabulary:
    """Ranks of a byte-level BPE, as read from a file of base64 tokens and ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for {len(missing)} single bytes")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        lines = Path(path).read_bytes().splitlines()
        pairs = (line.split() for line in lines if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Rank of the token that two tokens make, by both ids."""
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << _ID_BITS | right] = rank
        return found

    @cached_property
    def _sorted_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        ranks = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        order = np.argsort(keys)
        return np.append(keys[order], _NONE), np.append(ranks[order], _NONE)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs; ``_NONE`` for those that make no token."""
        keys, ranks = self._sorted_pairs
        wanted = left << _ID_BITS | right
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, ranks[at], _NONE)


def encode_long(vocabulary: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one piece of any length: n log n for n bytes."""
    n, pairs = len(piece), vocabulary.pairs
    leaves = 1 << max(1, (n - 1).bit_length())
    none = (int(_NONE), 0)
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        rank = pairs.get(ids[i] << _ID_BITS | ids[i + 1])
        if rank is not None:
            tree[leaves + i] = (rank, i)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, rank: int | None) -> None:
        node = leaves + i
        tree[node] = none if rank is None else (rank, i)
        while node > 1:
            node >>= 1
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                return
            tree[node] = best

    while tree[1] is not none and tree[1][0] < _NONE:
        rank, i = tree[1]
        gone = after[i]
        ids[i], ids[gone] = rank, -1
        after[i] = nxt = after[gone]
        put(gone, None)
        put(i, pairs.get(rank << _ID_BITS | ids[nxt]) if nxt < n else None)
        if nxt < n:
            before[nxt] = i
        if before[i] >= 0:
            put(before[i], pairs.get(ids[before[i]] << _ID_BITS | rank))
    return [i for i in ids if i >= 0]


def encode_short(vocabulary: Vocabulary, words: Sequence[bytes]) -> list[bytes]:
    """Ids, four bytes each, of pieces of at most ``_SHORT`` bytes; a step merges a pair in every piece."""
    lengths = np.array([len(w) for w in words])
    leaves = 1 << max(1, int(lengths.max() - 1).bit_length())
    rows, places = len(words), np.arange(leaves)
    raw = np.frombuffer(b"".join(w.ljust(leaves, b"\0") for w in words), np.uint8)
    live = places < lengths[:, None]
    ids = np.where(live, vocabulary.byte_ids[raw].reshape(rows, leaves), -1)
    # One more place at the end takes the links that lead out of a piece.
    after = np.tile(np.arange(1, leaves + 2), (rows, 1))
    before = np.tile(np.arange(-1, leaves), (rows, 1))
    tree = np.full((rows, 2 * leaves), _NONE)

    def keyed(ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(ranks < _NONE, ranks * leaves + at, _NONE)

    starts = live[:, 1:]
    ranks = np.full((rows, leaves), _NONE)
    ranks[:, :-1][starts] = vocabulary.pair_ranks(ids[:, :-1][starts], ids[:, 1:][starts])
    tree[:, leaves:] = keyed(ranks, places)
    for level in range(leaves.bit_length() - 2, -1, -1):
        node = slice(1 << level, 2 << level)
        tree[:, node] = tree[:, 2 << level : 4 << level].reshape(rows, -1, 2).min(axis=2)

    def put(row: np.ndarray, at: np.ndarray, keys: np.ndarray) -> None:
        node = leaves + at
        tree[row, node] = keys
        for _ in range(leaves.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.arange(rows)
    while (row := row[tree[row, 1] < _NONE]).size:
        rank, at = np.divmod(tree[row, 1], leaves)
        gone = after[row, at]
        nxt = after[row, gone]
        ids[row, at], ids[row, gone] = rank, -1
        after[row, at], before[row, nxt] = nxt, at
        put(row, gone, np.full(row.size, _NONE))
        follows = nxt < lengths[row]
        right = np.full(row.size, _NONE)
        right[follows] = vocabulary.pair_ranks(rank[follows], ids[row[follows], nxt[follows]])
        put(row, at, keyed(right, at))
        earlier = before[row, at]
        has = earlier >= 0
        pair_row, earlier = row[has], earlier[has]
        left = vocabulary.pair_ranks(ids[pair_row, earlier], rank[has])
        put(pair_row, earlier, keyed(left, earlier))
    counts = (ids >= 0).sum(axis=1)
    flat = ids[ids >= 0].astype(np.int32).tobytes()
    ends = (4 * counts.cumsum()).tolist()
    return [flat[start:end] for start, end in zip([0, *ends], ends, strict=False)]


class Encoder:
    """Encodes whole texts, keeping the ids of pieces seen before as four bytes each."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: Iterable[str]) -> None:
        by_leaves: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.vocabulary.ranks.get(raw)  # a piece that is a token needs no merge
            if rank is not None:
                self.known[piece] = np.int32(rank).tobytes()
            elif len(raw) > _SHORT:
                self.known[piece] = np.array(encode_long(self.vocabulary, raw), np.int32).tobytes()
            else:
                by_leaves.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for same in by_leaves.values():
            for start in range(0, len(same), _SIDE_BY_SIDE):
                block = same[start : start + _SIDE_BY_SIDE]
                ids = encode_short(self.vocabulary, [raw for _, raw in block])
                self.known.update(zip((piece for piece, _ in block), ids, strict=True))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, every match of the pattern encoded by itself."""
        cut = [self.split(text) for text in texts]
        distinct = set(chain.from_iterable(cut)).difference(self.known)
        if len(self.known) + len(distinct) > _KEPT_PIECES:
            self.known.clear()
            distinct = set(chain.from_iterable(cut))
        self._learn(distinct)
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, pieces)), np.int32) for pieces in cut]

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def worker_encoder(vocabulary_path: str, pattern: str) -> Encoder:
    """The encoder of a Python worker, kept from task to task."""
    return Encoder(Vocabulary.load(vocabulary_path), pattern)


def encode_documents(
    documents: DataFrame, vocabulary_path: str, pattern: str, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The carried columns and ids array<int> of every whole text; null is empty and has no ids."""

    def prepare() -> Callable[[list[str]], dict]:
        encoder = worker_encoder(vocabulary_path, pattern)

        def encode(texts: list[str]) -> dict:
            found = encoder.encode(texts)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            return {"ids": pa.ListArray.from_arrays(ends, np.concatenate(found))}

        return encode

    return map_texts(documents, carry, prepare, "ids array<int>")


def round_trip(
    documents: DataFrame, vocabulary_path: str, pattern: str, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The carried columns, n_tokens, ids_sha256 and decoded_sha256 of every whole text.

    Texts are encoded, and their ids decoded again. The first digest is of the decimal ids joined
    by one space, the second of the decoded bytes. Every row is handled by itself, so repeated
    rows, null ids and an empty table need no care.
    """

    def prepare() -> Callable[[list[str]], dict]:
        encoder = worker_encoder(vocabulary_path, pattern)
        decimal = {rank: str(rank) for rank in encoder.vocabulary.tokens}

        def digests(texts: list[str]) -> dict:
            ids = [found.tolist() for found in encoder.encode(texts)]
            written = (" ".join(map(decimal.__getitem__, i)) for i in ids)
            return {
                "n_tokens": [len(i) for i in ids],
                "ids_sha256": [sha256(w.encode()).hexdigest() for w in written],
                "decoded_sha256": [sha256(encoder.decode(i)).hexdigest() for i in ids],
            }

        return digests

    return map_texts(
        documents, carry, prepare, "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
