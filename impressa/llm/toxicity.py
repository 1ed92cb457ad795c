"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and beginnings of words is counted from the labelled documents. A document becomes
a few numbers: how dense lexicon entries of several strengths are, how near they stand to words that
address the reader, and its rates of capitals, punctuation and disguised spellings. Boosted trees
score these numbers; an isotonic fit on rows that the trees did not see turns scores into
probabilities.

The trees must not see rows by a lexicon that was counted from the same rows, which would make it look
better than it is. So the labelled documents are two halves, each described by the lexicon of the
other; documents to be scored are described by the lexicon of both.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.llm.batches import map_texts, pieces
from impressa.session import materialize

# Bounds of the model: rows that the trees and the calibration are fitted on, entries of the lexicon.
# Lexicon counts cover all labelled documents.
TREE_ROWS, CALIBRATION_ROWS = 20_000, 20_000
LEXICON = 5_000
FIT_TASKS = 4
# Beginnings of words of these lengths are entries besides whole words.
_BEGINNINGS = (4, 5, 6)
# Entries need so many documents, and a likelihood ratio that so many are expected to reach by chance.
_LEAST_DOCUMENTS, _BY_CHANCE = 3, 1
# The strength of an entry is its share of toxic documents, shrunk towards the share of all documents
# as if it had been seen in so many more; tiers of the lexicon begin at these strengths.
_PRIOR_DOCUMENTS = 8.0
_TIERS = (0.3, 0.5, 0.75)
# Lexicon entries this near (in words) to an address count as directed at the reader.
_NEAR = 5
_KEPT_WORDS, _KEPT_TERMS = 200_000, 400_000
SEED = 11

# Words that address the reader in English, German, French and Spanish.
ADDRESSES = frozenset(
    "you your yours yourself yourselves ur du dich dir dein deine deiner deinen ihr euch euer "
    "tu toi te ton ta tes vous votre vos tú ti usted ustedes vosotros contigo".split()
)
# Digits and signs that stand for letters in disguised words.
DISGUISES = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"[^\W\d_]+(?:[0-9@$!*|]+[^\W\d_]+)*")
_MIXED = re.compile(r"[0-9@$!*|]")
_RUN = re.compile(r"(.)\1{2,}")

FEATURES = (
    *[f"density_{i}" for i in range(len(_TIERS))],
    *[f"distinct_{i}" for i in range(len(_TIERS))],
    "strongest", "strength", "addresses", "near_address", "capitals", "capital_words", "marks",
    "mark_runs", "signs", "disguised", "disguised_entries", "letter_runs", "spaced", "log_words",
)


def fold(id_column: str, folds: int = 4) -> Column:
    """Remainder of the CRC-32 of the id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def plain(word: str) -> str:
    """A lower-case word without disguise: signs as the letters they stand for, runs shortened."""
    if not word.isalpha() and _MIXED.search(word):
        word = word.translate(DISGUISES)
    return _RUN.sub(r"\1", word)


def entries(word: str) -> list[str]:
    """Lexicon entries that a word can match: itself, and its beginnings with a mark behind them."""
    return [word, *[f"{word[:n]}-" for n in _BEGINNINGS if len(word) > n]]


# ---------------------------------------------------------------- lexicon


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, half, toxic, documents) of a task, given out whenever the store is full."""
    # By half: documents with an entry, and toxic ones.
    store = [(Counter(), Counter()) for _ in range(2)]
    known: dict[str, list[str]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for half, (documents, toxic) in enumerate(store):
            arrays = [
                pa.array(list(documents), pa.string()),
                pa.array([half] * len(documents), pa.int32()),
                pa.array([toxic[e] for e in documents], pa.int64()),
                pa.array(documents.values(), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["entry", "half", "toxic", "documents"])
            documents.clear()
            toxic.clear()

    for batch in batches:
        for piece in pieces(batch):
            rows = zip(*(piece[c].to_pylist() for c in ("text", "half", "toxic")), strict=True)
            for text, half, toxic in rows:
                words = set(_WORD.findall((text or "").lower()))
                if len(known) > _KEPT_WORDS:
                    known.clear()
                known.update((w, entries(plain(w))) for w in words.difference(known))
                found = set(chain.from_iterable(map(known.__getitem__, words)))
                store[half][0].update(found)
                if toxic:
                    store[half][1].update(found)
            if sum(len(documents) for documents, _ in store) > _KEPT_TERMS:
                yield from out()
    yield from out()


def _ratio(toxic: Column, documents: Column, share: Column) -> Column:
    """Log-likelihood ratio of an entry having another share of toxic documents; 0 if not a larger one."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(toxic, documents * share) + part(documents - toxic, documents * (1 - share)))
    return F.when(toxic > documents * share, ratio).otherwise(0.0)


def least_ratio(tested: int) -> float:
    """The log-likelihood ratio that about ``_BY_CHANCE`` of so many entries without meaning reach.

    Tail of the chi-squared distribution with one degree of freedom, upper side only, by its leading term.
    """
    ratio = 9.0
    for _ in range(20):
        ratio = max(9.0, 2 * math.log(max(tested, 1) / (2 * _BY_CHANCE)) - math.log(math.pi * ratio / 2))
    return ratio


@dataclass(frozen=True)
class Lexicons:
    """Strength by entry: of half 0, of half 1, and of both together."""

    halves: tuple[dict[str, float], dict[str, float]]
    whole: dict[str, float]


def learn_lexicons(labelled: DataFrame) -> Lexicons:
    """Lexicons of ``labelled`` (text, toxic int, half int), counted over all of its rows.

    An entry is kept if it is in at least three documents, and in toxic ones more often than chance
    explains; of those the ``LEXICON`` least likely ones, ties by entry. Without both labels there
    are none.
    """
    totals = labelled.groupBy("half").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("documents"))
    by_half = {r["half"]: (r["toxic"], r["documents"]) for r in totals.collect()}
    counted = (
        labelled.select("text", "half", "toxic")
        .mapInArrow(_count_entries, "entry string, half int, toxic bigint, documents bigint")
        .groupBy("entry")
        .agg(*[
            F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}_{h}")
            for h in (0, 1) for c in ("toxic", "documents")
        ])
        .filter(F.col("documents_0") + F.col("documents_1") >= _LEAST_DOCUMENTS)
    )
    counted = materialize(counted)
    least = least_ratio(counted.count())

    def strongest(halves: tuple[int, ...]) -> dict[str, float]:
        toxic, documents = (sum(by_half.get(h, (0, 0))[i] for h in halves) for i in (0, 1))
        if not 0 < toxic < documents:
            return {}
        seen = [reduce(add, [F.col(f"{c}_{h}") for h in halves]).cast("double") for c in ("toxic", "documents")]
        share = F.lit(toxic / documents)
        strength = (seen[0] + share * _PRIOR_DOCUMENTS) / (seen[1] + _PRIOR_DOCUMENTS)
        rows = (
            counted.filter(seen[1] >= _LEAST_DOCUMENTS)
            .select("entry", strength.alias("strength"), _ratio(*seen, share).alias("ratio"))
            .filter((F.col("ratio") >= least) & (F.col("strength") >= _TIERS[0]))
            .orderBy(F.desc("ratio"), "entry")
            .limit(LEXICON)
        )
        return {r["entry"]: r["strength"] for r in rows.collect()}

    return Lexicons((strongest((0,)), strongest((1,))), strongest((0, 1)))


# ---------------------------------------------------------------- features


def _runs(mask: np.ndarray, least: int) -> int:
    """How many runs of at least so many true values there are."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return int((edges[1::2] - edges[::2] >= least).sum())


class Describer:
    """Turns texts into feature rows by one lexicon, keeping what it found out about words."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.place: dict[str, int] = {}
        # Strength of a word, whether it is an address, whether it is disguised.
        self.facts = np.zeros((0, 3))

    def _learn(self, words: list[str]) -> None:
        new = set(words).difference(self.place)
        if not new:
            return
        if len(self.place) + len(new) > _KEPT_WORDS:
            self.place, self.facts = {}, self.facts[:0]
            new = set(words)
        strength = self.lexicon.get
        rows = []
        for word in new:
            clear = plain(word)
            rows.append((max(strength(e, 0.0) for e in entries(clear)), word in ADDRESSES, clear != word))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        if len(self.place) > len(self.facts):
            # Room for twice as many, so that rows are copied seldom.
            grown = np.zeros((max(4096, 2 * len(self.place)), 3))
            grown[: len(self.facts)] = self.facts
            self.facts = grown
        self.facts[len(self.place) - len(new) : len(self.place)] = rows

    def describe(self, text: str) -> list[float]:
        """The numbers of ``FEATURES``; zeros for a text without words."""
        found = _WORD.findall(text.lower())
        if not found:
            return [0.0] * len(FEATURES)
        self._learn(found)
        facts = self.facts[np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))]
        strength, address, disguised = facts[:, 0], facts[:, 1] > 0, facts[:, 2] > 0
        n, letters = len(found), len(text)
        hits = np.flatnonzero(strength)
        tiers = kinds = [0.0] * len(_TIERS)
        near = 0.0
        if len(hits):
            matched = np.array(list({found[i]: strength[i] for i in hits}.values()))
            tiers = [(strength >= t).sum() / n for t in _TIERS]
            kinds = [(matched >= t).sum() / n**0.5 for t in _TIERS]
            spoken = np.flatnonzero(address)
            if len(spoken):
                after = np.searchsorted(spoken, hits)
                gaps = np.minimum(
                    np.abs(spoken[np.minimum(after, len(spoken) - 1)] - hits), np.abs(hits - spoken[np.maximum(after - 1, 0)])
                )
                near = float((gaps <= _NEAR).sum()) / n
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        capital = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
        mark = (points == 33) | (points == 63)
        letter = (points >= 97) | ((points >= 65) & (points <= 90))
        same = (points[1:] == points[:-1]) & letter[1:]
        signs = ((points > 32) & (points < 127) & ~letter & ~((points >= 48) & (points <= 57))).sum()
        single = np.fromiter(map(len, found), np.int64, n) == 1
        return [
            *tiers, *kinds,
            float(strength.max()), float(strength.sum()) / n,
            address.mean(), near,
            capital.sum() / letters, _runs(capital, 3) / n,
            mark.sum() / n, _runs(mark, 2) / n, signs / letters,
            disguised.mean(), float((disguised & (strength > 0)).sum()) / n,
            _runs(same, 2) / n, _runs(single, 4) / n,
            float(np.log1p(n)),
        ]


def features(documents: DataFrame, lexicon: dict[str, float], carry: list[str]) -> DataFrame:
    """The carried columns of every row and its feature array ``numbers``."""

    def prepare() -> Callable[[list[str]], dict]:
        describer = Describer(lexicon)
        return lambda texts: {"numbers": [describer.describe(t) for t in texts]}

    return map_texts(documents, carry, prepare, "numbers array<double>")


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class Model:
    """Lexicon, trees and calibration; without trees every text scores ``base``."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Rows with the raw score of the trees as ``margin``."""
    scored = trees.transform(rows.withColumn("features", array_to_vector("numbers")))
    margin = vector_to_array("rawPrediction")[1]
    return scored.withColumn("margin", margin).drop("features", "rawPrediction", "probability", "prediction")


def _at_most(rows: DataFrame, bound: int, key: Column) -> DataFrame:
    """About ``bound`` rows of a table at most, by a hash that no partitioning changes."""
    share = min(1.0, bound / max(1, rows.count()))
    return rows if share == 1.0 else rows.filter(F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))


def learn(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> Model:
    """A model of the documents that have a label; ``labels`` has (doc_id, toxic 0/1).

    Of repeated labels of a document the largest counts; null labels and null ids are left out, a null
    text is empty, and rows that share an id are all learned from. Trees are fitted on about
    ``TREE_ROWS`` labelled rows, the calibration on about ``CALIBRATION_ROWS`` others, chosen by a
    hash of the id. With one label only, or no labelled row, every text scores the share of toxic rows.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    digest = F.xxhash64("id", F.lit(SEED))
    labelled = materialize(
        documents.select(F.col(id_column).alias("id"), "text")
        # Labels grow with the documents: the join is a shuffled one at every size.
        .join(known.hint("merge"), "id")
        .select(
            "id", "text", "toxic",
            F.pmod(digest, F.lit(2)).cast("int").alias("half"),
            (F.pmod(F.shiftright(digest, 20), F.lit(4)) == 0).alias("calibrates"),
        )
    )
    facts = labelled.agg(F.count("*").alias("rows"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    base = facts["toxic"] / facts["rows"] if facts["rows"] else 0.0
    lexicons = learn_lexicons(labelled)
    if base in (0.0, 1.0):
        return Model({}, None, None, base)
    # Each half by the lexicon of the other.
    halves = [
        features(labelled.filter(F.col("half") == h), lexicons.halves[1 - h], ["id", "toxic", "calibrates"])
        for h in (0, 1)
    ]
    rows = materialize(
        halves[0].unionByName(halves[1]).withColumn("label", F.col("toxic").cast("double"))
    )
    # Bounded and narrow, so that few tasks serve the many passes of the trees.
    fitted = materialize(_at_most(rows.filter(~F.col("calibrates")), TREE_ROWS, F.col("id")).coalesce(FIT_TASKS))
    apart = _at_most(rows.filter(F.col("calibrates")), CALIBRATION_ROWS, F.col("id"))
    size = fitted.agg(F.count("*").alias("rows"), F.count_distinct("label").alias("labels")).first()
    if size["labels"] < 2:
        return Model(lexicons.whole, None, None, base)
    # Leaves hold a hundredth of the rows at least: labels are wrong now and then, and a smaller leaf would
    # learn those.
    booster = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=SEED,
        minInstancesPerNode=max(3, size["rows"] // 100),
    )
    trees = booster.fit(fitted.withColumn("features", array_to_vector("numbers")))
    # Most clean texts have one margin: equal margins are one weighted point, not many rows of one key.
    points = _margin(trees, apart).groupBy("margin").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("rows"))
    points = materialize(points)
    shares = points.agg(F.min("label").alias("low"), F.max("label").alias("top")).first()
    if shares["low"] is None or shares["low"] == shares["top"]:
        return Model(lexicons.whole, trees, None, base)
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="rows").fit(points)
    return Model(lexicons.whole, trees, calibration, base)


def score(documents: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The carried columns and ``score`` (0 to 1) of whole texts, from the texts alone.

    A null text is empty; an empty text is scored by the model like any other. Rows are scored one by
    one: repeated rows score alike, null ids need no care, an empty table gives no rows.
    """
    if model.trees is None:
        return documents.select(*[F.col(f"`{c}`") for c in carry], F.lit(model.base).alias("score"))
    inner = {f"_held{i}": c for i, c in enumerate(carry)}
    renamed = documents.select("text", *[F.col(f"`{c}`").alias(n) for n, c in inner.items()])
    scored = _margin(model.trees, features(renamed, model.lexicon, list(inner)))
    if model.calibration is None:
        result = 1 / (1 + F.exp(-2 * F.col("margin")))
    else:
        scored = model.calibration.transform(scored)
        result = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction")))
    return scored.select(*[F.col(n).alias(c) for n, c in inner.items()], result.alias("score"))
