"""Exact token counts of every prefix of a text, by dynamic programming over a piece vocabulary.

The vocabulary merges the adjacent pair with the best score first, leftmost on ties. Of such an
encoding every two neighbouring tokens, encoded by themselves, give the same two tokens, and any
sequence with that property is the encoding of its text. So the last token of a prefix is the one
token ending there that stands well beside the last token of the prefix before it, and the count of
a prefix is that of the shorter prefix plus one. Stored counts answer how long a prefix is in
tokens, and how much text fits a budget, without encoding again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain, pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from impressa.llm.batches import map_texts

# Fixed value: the sign that stands for a space in pieces.
SPACE = "▁"
# Results kept by a worker; beyond it the stores start afresh.
_KEPT_CHUNKS = 600_000
_KEPT_PAIRS = 2_000_000
# Ids of characters without a piece lie above those of pieces.
_BARE = 1 << 21
_END = ""


class PieceVocabulary:
    """Pieces with their scores; characters without a piece count as their UTF-8 bytes."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.pieces = list(scores)
        # Pieces spelled backwards, a dictionary per character; ``_END`` has the piece's number.
        self.backwards: dict = {}
        for number, piece in enumerate(self.pieces):
            node = self.backwards
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[_END] = number
        self.chunks = re.compile(self._chunk_pattern(), re.DOTALL)

    def _chunk_pattern(self) -> str:
        """Runs of characters that pieces can join, with the spaces before them.

        Characters beside each other in some piece belong together, and so do all that such chains
        reach. No token holds characters of two groups, or a space after anything but a space.
        """
        group: dict[str, str] = {}

        def root(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        for piece in self.pieces:
            bare = piece.lstrip(SPACE)
            if SPACE in bare:
                raise ValueError(f"a piece has a space inside: {piece}")
            for left, right in pairwise(bare):
                group[root(left)] = root(right)
        members: dict[str, list[str]] = {}
        for c in sorted(group):
            members.setdefault(root(c), []).append(re.escape(c))
        runs = "|".join(f"[{''.join(m)}]+" for m in sorted(members.values(), key=len, reverse=True))
        return f"{SPACE}*(?:{runs}|[^{SPACE}])|{SPACE}+" if runs else f"{SPACE}*[^{SPACE}]|{SPACE}+"

    @classmethod
    def load(cls, path: str) -> PieceVocabulary:
        model = SentencePieceProcessor(model_file=path)
        left_out = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        plain = (i for i in range(model.get_piece_size()) if not any(f(i) for f in left_out))
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text, merge by merge."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


class PrefixCounter:
    """Token counts of the prefixes of texts, keeping the totals of chunks seen before."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary = vocabulary
        self._pairs: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self._totals: dict[str, int] = {}

    def _text(self, token: int) -> str:
        return chr(token - _BARE) if token >= _BARE else self.vocabulary.pieces[token]

    def _side_by_side(self, left: int, right: int) -> bool:
        """Whether the two tokens come out of the encoding of their joint text; kept."""
        texts = [self._text(left), self._text(right)]
        if len(self._pairs) >= _KEPT_PAIRS:
            self._pairs.clear()
        stands = self._pairs[left << 32 | right] = self.vocabulary.merged("".join(texts)) == texts
        return stands

    def _stands_alone(self, piece: int) -> bool:
        text = self._text(piece)
        stands = self._alone[piece] = self.vocabulary.merged(text) == [text]
        return stands

    def _extend(self, chunk: str, counts: list[int], last: list[int]) -> None:
        """Counts and last tokens of the prefixes of ``chunk``, from the longest one given on."""
        backwards, pairs, alone = self.vocabulary.backwards, self._pairs, self._alone
        for end in range(len(counts), len(chunk) + 1):
            node, start, found = backwards, end, []
            while start:
                start -= 1
                node = node.get(chunk[start])
                if node is None:
                    break
                if _END in node:
                    found.append((start, node[_END]))
            for start, piece in reversed(found):
                if start:
                    stands = pairs.get(last[start] << 32 | piece)
                    if stands is None:
                        stands = self._side_by_side(last[start], piece)
                else:
                    stands = alone.get(piece)
                    if stands is None:
                        stands = self._stands_alone(piece)
                if stands:
                    counts.append(counts[start] + 1)
                    last.append(piece)
                    break
            else:
                # Not the end of a piece: its bytes, beside which nothing merges.
                character = chunk[end - 1]
                counts.append(counts[end - 1] + len(character.encode()))
                last.append(_BARE + ord(character))

    def _chunked(self, text: str) -> list[str]:
        return self.vocabulary.chunks.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def totals(self, texts: Sequence[str]) -> list[int]:
        """Tokens of whole texts. New chunks go in order, each going on from the prefix it shares."""
        cut = [self._chunked(text) for text in texts]
        known = self._totals
        new = set(chain.from_iterable(cut)).difference(known)
        if len(known) + len(new) > _KEPT_CHUNKS:
            known.clear()
            new = set(chain.from_iterable(cut))
        counts, last, before = [0], [-1], ""
        for chunk in sorted(new):
            shared = 0
            for a, b in zip(before, chunk, strict=False):
                if a != b:
                    break
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :]
            self._extend(chunk, counts, last)
            known[chunk] = counts[-1]
            before = chunk
        return [sum(map(known.__getitem__, chunks)) for chunks in cut]

    def prefixes(self, text: str) -> list[int]:
        """Tokens of the prefix of each length, from 0 to all characters of the text."""
        # The space put before a text is no token while the text is empty.
        found, before = [], 0
        for chunk in self._chunked(text):
            counts, last = [0], [-1]
            self._extend(chunk, counts, last)
            found.extend(before + n for n in counts[1:])
            before = found[-1]
        return [0, *found[1:]]


@lru_cache(maxsize=1)
def worker_counter(model_path: str) -> PrefixCounter:
    """The counter of a Python worker, kept from task to task."""
    return PrefixCounter(PieceVocabulary.load(model_path))


def token_totals(
    documents: DataFrame, model_path: str, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The carried columns, n_bytes and n_tokens of every whole text; null is empty and has none.

    Rows are handled one by one: repeated rows, null ids and an empty table need no care. Memory
    grows with the longest text only.
    """

    def prepare() -> Callable[[list[str]], dict]:
        counter = worker_counter(model_path)
        return lambda texts: {
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": counter.totals(texts),
        }

    return map_texts(documents, carry, prepare, "n_bytes bigint, n_tokens bigint")


def prefix_counts(
    documents: DataFrame, model_path: str, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The carried columns and prefix_tokens array<int>: tokens of the prefixes of 0, 1, ... characters."""

    def prepare() -> Callable[[list[str]], dict]:
        counter = worker_counter(model_path)
        return lambda texts: {"prefix_tokens": [counter.prefixes(t) for t in texts]}

    return map_texts(documents, carry, prepare, "prefix_tokens array<int>")


def tokens_at(prefix_tokens: Column, characters: Column) -> Column:
    """Tokens of the prefix of so many characters, from stored counts."""
    return F.get(prefix_tokens, characters)


def characters_within(prefix_tokens: Column, budget: Column) -> Column:
    """Length in characters of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)
