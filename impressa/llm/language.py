"""Language identification by a mixture of languages, fitted to each document by EM.

Every word is taken to be written in one of the learned languages, with the likelihood that its
letter trigrams have there. Expectation-maximisation finds the proportions of languages that make a
document most likely; the set of languages with a share is selected by likelihood after a penalty per
language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.llm.batches import map_texts, pieces

# Trigrams are counted in this many hash buckets, which bounds the model by the languages.
BUCKETS = 1 << 16
UNKNOWN = "und"
# Added to each count, so that an unseen trigram is possible in every language.
_SMOOTHING = 0.1
# Rounds of EM for proportions, and those for the order in which languages are tried.
_ROUNDS, _ORDERING_ROUNDS = 15, 3
# Elements of the word-by-language table of documents handled at once.
_TABLE = 1 << 18
_KEPT_WORDS = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased; number signs such as one half are no letters."""
    found = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def trigram_buckets(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, bucket) of each trigram of words, with a blank before and after a word."""
    joined = f" {' '.join(distinct)} "
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    middle = points[1:-1] != 32
    code = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (
        points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    )
    code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ points[2:]) * np.uint64(0x94D049BB133111EB)
    bucket = (code >> np.uint64(48)).astype(np.int64)
    word = np.cumsum(points == 32)[1:-1] - 1
    return word[middle], bucket[middle]


# ---------------------------------------------------------------- learning


@dataclass(frozen=True)
class Model:
    """Log probability of each trigram bucket (row) in each language (column)."""

    languages: tuple[str, ...]
    log_p: np.ndarray

    def unknown_log_p(self) -> np.ndarray:
        """Log probability that a language outside the model gives each trigram, by language.

        Half way between the mean log probability of a language's own trigrams and that of buckets
        drawn evenly, so that it needs no other language and no second look at the texts.
        """
        own = (np.exp(self.log_p) * self.log_p).sum(axis=0)
        return (own - np.log(BUCKETS)) / 2


def learn(labelled: DataFrame) -> Model:
    """A model of all rows of ``labelled`` (lang, text); null languages and texts are left out.

    Trigrams are added up per task and language before the shuffle. What reaches the driver is the
    model: at most ``BUCKETS`` counts per language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch):
                seen: dict[str, Counter] = {}
                for lang, text in zip(piece["lang"].to_pylist(), piece["text"].to_pylist(), strict=True):
                    seen.setdefault(lang, Counter()).update(words(text))
                for lang, counts in seen.items():
                    if counts:
                        word, bucket = trigram_buckets(list(counts))
                        weights = np.fromiter(counts.values(), np.float64, len(counts))[word]
                        found = np.bincount(bucket, weights, BUCKETS).astype(np.int64)
                        totals[lang] = totals.get(lang, 0) + found
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )

    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = known.select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    column = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((BUCKETS, len(languages)))
    at = [column[lang] for lang in table["lang"].to_pylist()]
    counts[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
    counts += _SMOOTHING
    return Model(tuple(languages), np.log(counts / counts.sum(axis=0)))


# ---------------------------------------------------------------- mixtures


def mixtures(
    likelihood: np.ndarray, starts: np.ndarray, rounds: int = _ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages (columns) and log likelihood of each document, by EM.

    ``likelihood`` has a row per word, scaled by any factor of the word; documents begin at
    ``starts``.
    """
    sizes = np.diff(np.append(starts, len(likelihood)))
    shares = np.full((len(starts), likelihood.shape[1]), 1 / likelihood.shape[1])
    for _ in range(rounds):
        joint = likelihood * np.repeat(shares, sizes, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(joint, starts, axis=0) / sizes[:, None]
    total = (likelihood * np.repeat(shares, sizes, axis=0)).sum(axis=1)
    return shares, np.add.reduceat(np.log(total), starts)


def best_mixtures(log_likelihood: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions of a language set with a good penalised likelihood, for each document, found greedily.

    Languages join in the order of their proportions among all languages, each at the price of half
    the logarithm of the number of words, as long as that makes the value better. A language that
    does not hold one word is not tried. Only sets of leading languages are compared, so a better set that
    leaves out the first one is not found; documents of few words or close languages can have such sets.
    """
    top = log_likelihood.max(axis=1, keepdims=True)
    likelihood = np.exp(np.maximum(log_likelihood - top, -60.0))
    sizes = np.diff(np.append(starts, len(likelihood)))
    first, _ = mixtures(likelihood, starts, _ORDERING_ROUNDS)
    order = (-first).argsort(axis=1, kind="stable")
    words_held = np.take_along_axis(first, order, axis=1) * sizes[:, None]
    price = 0.5 * np.log(sizes + 1.0)
    best = np.zeros_like(first)
    np.put_along_axis(best, order[:, :1], 1.0, axis=1)
    single = likelihood[np.arange(len(likelihood)), np.repeat(order[:, 0], sizes)]
    best_value = np.add.reduceat(np.log(single), starts) - price
    better = np.arange(len(starts))
    for size in range(2, likelihood.shape[1] + 1):
        tried = better[words_held[better, size - 1] >= 1.0]
        if not len(tried):
            break
        counts = sizes[tried]
        chosen = np.zeros(len(starts), bool)
        chosen[tried] = True
        columns = np.repeat(order[tried, :size], counts, axis=0)
        part = np.take_along_axis(likelihood[np.repeat(chosen, sizes)], columns, axis=1)
        shares, value = mixtures(part, np.concatenate(([0], counts.cumsum()[:-1])))
        value = value - size * price[tried]
        gain = value > best_value[tried]
        better = tried[gain]
        best[better] = 0
        best[better[:, None], order[better, :size]] = shares[gain]
        best_value[better] = value[gain]
    return best


def unknown_shares(
    log_likelihood: np.ndarray, trigrams: np.ndarray, starts: np.ndarray, shares: np.ndarray,
    unknown_log_p: np.ndarray,
) -> np.ndarray:
    """Share of the words of each document that no language of its mixture explains, by EM.

    The mixture, with its ``shares`` held, is one component; a language that gives ``unknown_log_p``
    to any trigram is the other.
    """
    sizes = np.diff(np.append(starts, len(log_likelihood)))
    top = log_likelihood.max(axis=1)
    likelihood = np.exp(np.maximum(log_likelihood - top[:, None], -60.0))
    known = top + np.log((likelihood * np.repeat(shares, sizes, axis=0)).sum(axis=1))
    outside = np.repeat(shares @ unknown_log_p, sizes) * trigrams
    ratio = np.exp(np.clip(outside - known, -60.0, 60.0))
    unknown = np.full(len(starts), 0.5)
    for _ in range(_ROUNDS):
        part = np.repeat(unknown, sizes)
        part = part * ratio / (part * ratio + 1 - part)
        unknown = np.minimum(np.add.reduceat(part, starts) / sizes, 1.0)
    return unknown


class Identifier:
    """Finds the mixtures of texts, keeping the likelihoods of words seen before."""

    def __init__(self, model: Model, unknown: bool = True):
        self.model = model
        self.unknown_log_p = model.unknown_log_p() if unknown else None
        self.place: dict[str, int] = {}
        # Log likelihoods of a word by language, and its number of trigrams.
        self.rows = np.zeros((0, len(model.languages) + 1))

    def _learn(self, distinct: list[str]) -> None:
        word, bucket = trigram_buckets(distinct)
        log_p = self.model.log_p[bucket]
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        found = np.column_stack((np.add.reduceat(log_p, begins, axis=0), np.diff(np.append(begins, len(word)))))
        self.place.update(zip(distinct, range(len(self.place), len(self.place) + len(distinct)), strict=True))
        self.rows = np.concatenate((self.rows, found))

    def shares(self, texts: list[str]) -> np.ndarray:
        """Proportions of languages, a row per text; a text without letters has none."""
        return self.fits(texts)[:, :-1]

    def fits(self, texts: list[str]) -> np.ndarray:
        """Proportions of languages, then the share of unknown words; 1 for a text without letters.

        Where the identifier does not look for unknown words, a text with letters has none.
        """
        languages = len(self.model.languages)
        result = np.zeros((len(texts), languages + 1))
        result[:, -1] = 1.0
        if not languages:
            return result
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            found = words(text)
            if found:
                held.append((i, found))
                size += len(found) * languages
            if size > _TABLE:
                self._fit(held, result)
                held, size = [], 0
        if held:
            self._fit(held, result)
        return result

    def _fit(self, held: list[tuple[int, list[str]]], result: np.ndarray) -> None:
        flat = [w for _, found in held for w in found]
        new = sorted(set(flat).difference(self.place))
        if len(self.place) + len(new) > _KEPT_WORDS:
            self.place, self.rows = {}, self.rows[:0]
            new = sorted(set(flat))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        sizes = [len(found) for _, found in held]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        log_likelihood, trigrams = self.rows[at, :-1], self.rows[at, -1]
        shares = best_mixtures(log_likelihood, starts)
        unknown = np.zeros(len(starts))
        if self.unknown_log_p is not None:
            unknown = unknown_shares(log_likelihood, trigrams, starts, shares, self.unknown_log_p)
        result[[i for i, _ in held]] = np.column_stack((shares, unknown))


def identify(
    documents: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",), unknown: bool = False
) -> DataFrame:
    """The carried columns, lang_pred, score and languages of whole texts, from these alone.

    ``languages`` lists (lang, share) by falling share, ties by name; the first is ``lang_pred`` and
    its share the score. With ``unknown`` there is a column of that name, the share of words that these
    languages do not explain. A null text, a text without letters, and any text where no language was
    learned have ``und``, score 0, no languages and unknown 1. Rows are handled one by one, so repeated rows
    and null ids need no care.
    """

    def prepare() -> Callable[[list[str]], dict]:
        identifier = Identifier(model, unknown)

        def predict(texts: list[str]) -> dict:
            fits = identifier.fits(texts)
            shares = fits[:, :-1]
            order = (-shares).argsort(axis=1, kind="stable")
            found = [
                [{"lang": model.languages[k], "share": row[k]} for k in by_share if row[k] > 0]
                for row, by_share in zip(shares.tolist(), order.tolist(), strict=True)
            ]
            return {
                "lang_pred": [f[0]["lang"] if f else UNKNOWN for f in found],
                "score": [min(1.0, f[0]["share"]) if f else 0.0 for f in found],
                "languages": found,
                "unknown": fits[:, -1],
            }

        return predict

    schema = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    return map_texts(documents, carry, prepare, f"{schema}, unknown double" if unknown else schema)


def fold(id_column: str) -> Column:
    """Remainder by 3 of the CRC-32 of the id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3, F.lit(0))
