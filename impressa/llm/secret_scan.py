"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

Patterns raise every key, password in a URL, assignment and long token that could be a secret. Features describe the
candidate (length, character transitions and dictionary coverage as counted over the corpus, signs of a
path) and the words around it. A forest trained on labelled findings decides which ones are secrets. All of it is
column expressions and the ML library's own trees.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from impressa.llm.findings import labelled_texts
from impressa.session import materialize

# Formats of keys.
# The body of a private key goes to the next five dashes, with headers and written-out line ends.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?>[\s\S]*?-----)"
    r"END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
)
CLOUD_KEY = r"(?:AKIA|ASIA)[A-Z0-9]{16}"
PREFIXED_KEY = (
    r"(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)"
)
CREDENTIAL_WORDS = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "credential", "auth", "bearer",
    "apikey", "api_key", "api-key", "api key", "access_key", "private_key",
)
HARMLESS_WORDS = (
    "commit", "revision", "checksum", "digest", "sha", "md5", "uuid", "guid", "version", "mail",
    "phone", "call", "card", "isbn", "href", "src", "example", "sample", "dummy", "placeholder",
)
_TOKEN = "A-Za-z0-9+/=_.@:~%-"
_NAMED = "|".join(CREDENTIAL_WORDS)
# Patterns with a lead before the value, which is one of the groups that follow.
URL_CREDENTIAL = r"(://[^\s/:@\"'<>]*:)([^\s/\"'<>]+)@"
ASSIGNMENT = (
    rf"((?i:{_NAMED})[A-Za-z0-9_-]{{0,20}}(?:\\?[\"'])?\s{{0,3}}(?::=|=>|={{1,3}}|:)\s{{0,3}})"
    r"(?:\"([^\"\n]+)\"|'([^'\n]+)'|(?:\\?[\"'])?([^\s\"'<>]+))"
)
# Searched one after the other, each in what the earlier ones have left.
KINDS = {
    "private_key": PRIVATE_KEY,
    "cloud_key": rf"(?<![A-Za-z0-9]){CLOUD_KEY}(?![A-Za-z0-9])",
    "prefixed_key": rf"(?<![A-Za-z0-9]){PREFIXED_KEY}",
    "url_credential": URL_CREDENTIAL,
    "assignment": ASSIGNMENT,
    "token": rf"(?<![{_TOKEN}])(?=[A-Za-z+/=_.@:~%-]*[0-9])[{_TOKEN}]+",
}
FIXED_FORMATS = ("private_key", "cloud_key", "prefixed_key")
# Stands for characters that are taken; no pattern but that of private keys goes over it.
_TAKEN = "\n"
# Characters before and after a candidate that count as its neighbourhood.
NEIGHBOURHOOD = 40
# At most so many labelled findings of either label, by hash of the finding, train a forest.
TRAINING_FINDINGS = 20_000
# Words of the corpus, most frequent first, that count as its dictionary; a word seen once is left out, as it
# may be a secret itself; the first of them also stand
# around the labelled findings.
DICTIONARY_WORDS, COMMON_WORDS = 20_000, 2_000
# A longer run of letters is no word.
_WORD_LENGTH = 40
# Shorter values are replaced elsewhere in their text only where they stand alone.
COPIED = 8
_KEY = "_row_key"

FEATURES = (
    "length", "digits", "uppers", "distinct", "transitions", "letter_pairs", "dictionary", "repeats",
    "path_signs", "dots", "code_signs", "spaces", "at_sign", "scheme", "extension", "hexadecimal", "uuid",
    "placeholder", "word_form", "in_url", "known_format", "named", "credential_word", "harmless_word", "assigned",
    "quoted", "words_around",
)


@dataclass(frozen=True)
class CorpusLanguage:
    """What the scanned corpus says about words: bounded tables, whatever its size."""

    # (word): the DICTIONARY_WORDS most frequent ones.
    dictionary: DataFrame
    # One row: ``common``, the first COMMON_WORDS of them, and ``pairs``, 26 x 26 log probabilities of letters after letters.
    row: DataFrame


def corpus_language(documents: DataFrame) -> CorpusLanguage:
    """Words and letter transitions counted over all texts; without words, an empty dictionary and even odds."""
    spark = documents.sparkSession
    parts = documents.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("part"))
    counted = parts.filter(F.length("part").between(2, _WORD_LENGTH)).groupBy("part").agg(F.count("*").alias("n"))
    word = F.regexp_extract("part", r"^\p{Punct}{0,2}(\p{L}{2,})\p{Punct}{0,3}$", 1)
    words = counted.select(word.alias("word"), "n").filter("word <> ''")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")))
    frequent = words.filter("n > 1").orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS)
    dictionary = materialize(frequent)
    first = dictionary.orderBy(F.desc("n"), "word").limit(COMMON_WORDS)
    common = first.agg(F.sort_array(F.collect_list(F.struct(F.negative("n").alias("m"), "word")))["word"].alias("common"))
    letters = words.select("n", F.transform(F.split("word", ""), lambda c: F.ascii(c) - 97).alias("c"))
    places = letters.select("n", F.explode(_places("c")).alias("place")).groupBy("place").agg(F.sum("n").alias("n"))
    grid = spark.range(26 * 26).select(F.col("id").cast("int").alias("place"))
    seen = grid.join(F.broadcast(places), "place", "left").fillna(0, subset=["n"])
    rest = F.sum("n").over(Window.partitionBy(F.expr("place div 26")))
    logs = seen.select("place", F.log((F.col("n") + 1.0) / (rest + 26.0)).alias("p"))
    pairs = logs.agg(F.sort_array(F.collect_list(F.struct("place", "p")))["p"].alias("pairs"))
    return CorpusLanguage(dictionary.select("word"), materialize(common.join(F.broadcast(pairs))))


def _places(codes: str) -> Column:
    """Places in the grid of letters of all pairs of neighbours that are both from a to z."""
    after = F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0)))
    both = F.zip_with(codes, after, lambda a, b: F.when(a.between(0, 25) & b.between(0, 25), a * 26 + b))
    return F.filter(both, lambda place: place.isNotNull())


def _piece(match: Column, at: Column) -> Column:
    """A match with the length of the text before it, and its neighbourhood."""
    return F.struct(
        at.alias("at"),
        match.alias("match"),
        F.length(F.col("_gaps")[at]).alias("gap"),
        F.right(F.col("_gaps")[at], F.lit(NEIGHBOURHOOD)).alias("before"),
        F.left(F.col("_gaps")[at + 1], F.lit(NEIGHBOURHOOD)).alias("after"),
    )


def candidates(documents: DataFrame) -> DataFrame:
    """(_row, doc_id, kind, value, start, before, after): every possible secret, positions from 0.

    A row per match in a whole text; null texts have none. ``start`` counts code points, ``_row`` tells rows
    of ``documents`` apart. Kinds are
    searched one after the other, the matches of earlier ones blanked out by as many characters, so
    that no match hides or cuts one of a stronger kind and none overlap. The pieces between matches
    tell where each match lies; their lengths are added up per text and kind.
    """
    found = documents.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", F.col("text").alias("_left")
    )
    for kind, pattern in KINDS.items():
        # Steps of their own, so that no pattern is searched more often than it is written here.
        found = found.withColumn("_found", F.regexp_extract_all("_left", F.lit(pattern), F.lit(0)))
        some = F.size("_found") > 0
        found = found.withColumn("_gaps", F.when(some, F.split("_left", pattern, -1)))
        blanked = F.zip_with(
            "_gaps",
            "_found",
            lambda g, m: F.concat(g, F.coalesce(F.repeat(F.lit(_TAKEN), F.length(m)), F.lit(""))),
        )
        found = found.withColumns(
            {
                f"_{kind}": F.when(some, F.transform("_found", _piece)),
                "_left": F.when(some, F.array_join(blanked, "")).otherwise(F.col("_left")),
            }
        )
    by_kind = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("pieces")) for k in KINDS])
    # A filter, also one that explode() implies, would be moved down and search the texts again.
    held = F.filter(by_kind, lambda k: k["pieces"].isNotNull())
    pieces = found.select("_row", "doc_id", F.explode_outer(held).alias("_kind"))
    pieces = pieces.select("_row", "doc_id", "_kind.kind", F.explode("_kind.pieces").alias("_piece"))
    # Row numbers are fixed by writing them, before rows are shuffled by them.
    pieces = materialize(pieces.select("_row", "doc_id", "kind", "_piece.*"))
    upto = Window.partitionBy("_row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("match")).over(upto) - F.length("match")
    kind, match = F.col("kind"), F.col("match")
    group = lambda pattern, i: F.regexp_extract(match, pattern, i)
    bare = F.regexp_replace(group(ASSIGNMENT, 4), r"[.,;:)\]}]+$", "")
    value = (
        F.when(kind.isin(*FIXED_FORMATS), match)
        .when(kind == "url_credential", group(URL_CREDENTIAL, 2))
        .when(kind == "assignment", F.concat(group(ASSIGNMENT, 2), group(ASSIGNMENT, 3), bare))
        .otherwise(F.regexp_replace(match, r"[.:,;~%-]+$", ""))
    )
    lead = (
        F.when(kind == "url_credential", group(URL_CREDENTIAL, 1))
        .when(kind == "assignment", group(ASSIGNMENT, 1))
        .otherwise(F.lit(""))
    )
    located = pieces.withColumns({"_start": start, "value": value, "_lead": F.length(lead)})
    located = located.filter(F.col("value") != "").withColumn(
        "_within",
        F.col("_lead") + F.instr(F.substring(match, F.col("_lead") + 1, F.length(match)), F.col("value")) - 1,
    )
    return located.select(
        "_row",
        "doc_id",
        "kind",
        "value",
        (F.col("_start") + F.col("_within")).cast("bigint").alias("start"),
        F.concat("before", F.substring(match, F.lit(1), F.col("_within"))).alias("before"),
        F.concat(
            F.substring(match, F.col("_within") + F.length("value") + 1, F.length(match)), F.col("after")
        ).alias("after"),
    )


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters of ``value`` that ``pattern`` matches."""
    left = F.length(F.regexp_replace(value, pattern, ""))
    return 1.0 - left / F.greatest(F.length(value), F.lit(1))


def with_features(found: DataFrame, language: CorpusLanguage) -> DataFrame:
    """``found`` with the double columns ``FEATURES``."""
    runs = F.regexp_extract_all("value", F.lit(r"\p{Lu}?\p{Ll}+|\p{Lu}+"), F.lit(0))
    places = ["_row", "kind", "start"]
    words = found.select(*places, F.explode(runs).alias("_run")).withColumn("word", F.lower("_run"))
    covered = words.join(F.broadcast(language.dictionary), "word").groupBy(*places).agg(
        F.sum(F.length("_run")).alias("_covered")
    )
    found = found.join(covered, places, "left").join(F.broadcast(language.row.select("pairs")))
    found = found.withColumn("_codes", F.transform(F.split(F.lower("value"), ""), lambda c: F.ascii(c) - 97))
    found = found.withColumn("_places", _places("_codes"))
    value, before, after = F.col("value"), F.lower("before"), F.lower("after")
    size = F.greatest(F.length(value), F.lit(1)).cast("double")
    classes = F.size(F.regexp_extract_all(value, F.lit("[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0)))
    likely = F.aggregate("_places", F.lit(0.0), lambda total, place: total + F.get("pairs", place))
    features = {
        "length": size,
        "digits": _share(value, "[0-9]"),
        "uppers": _share(value, "[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        # Runs of one class of characters, less one, by length.
        "transitions": (classes - 1) / size,
        # Mean log probability of a letter after the one before it, as the corpus has them.
        "letter_pairs": F.when(F.size("_places") > 0, likely / F.size("_places")).otherwise(0.0),
        "dictionary": F.coalesce(F.col("_covered"), F.lit(0)) / size,
        "repeats": _share(value, r"(.)\1{3,}"),
        "path_signs": F.length(F.regexp_replace(value, r"[^/\\~?&]", "")) / size,
        "dots": F.length(F.regexp_replace(value, r"[^.:]", "")) / size,
        "code_signs": _share(value, r"[(){}<>\[\]$%*]"),
        "spaces": _share(value, r"\s"),
        "at_sign": value.rlike(r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"),
        "scheme": value.contains("://") | F.lower(value).startswith("www."),
        "extension": value.rlike(r"\.[A-Za-z]{2,4}$"),
        "hexadecimal": value.rlike(r"^[0-9a-f]+$"),
        "uuid": value.rlike(r"^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"),
        "placeholder": value.rlike(r"(?i)example|placeholder|changeme|xxxx|dummy|sample|your"),
        "word_form": value.rlike(r"^\p{L}+$"),
        "in_url": F.col("kind") == "url_credential",
        "known_format": F.col("kind").isin(*FIXED_FORMATS),
        "named": F.col("kind") == "assignment",
        "credential_word": before.rlike("|".join(CREDENTIAL_WORDS)),
        "harmless_word": F.concat(before, F.lit(" "), after).rlike(rf"\b(?:{'|'.join(HARMLESS_WORDS)})"),
        "assigned": before.rlike(r"[:=]\s*[\"']?$"),
        "quoted": before.rlike(r"[\"']$") & after.rlike(r"^[\"']"),
        "words_around": F.size(F.regexp_extract_all(F.concat(before, F.lit(" "), after), F.lit(r"\p{L}{2,}"), F.lit(0))),
    }
    described = found.withColumns({name: features[name].cast("double") for name in FEATURES})
    return described.drop("_covered", "pairs", "_codes", "_places")


def labelled_findings(examples: DataFrame, language: CorpusLanguage) -> DataFrame:
    """Findings with ``FEATURES`` and ``label`` from (text, value, label), texts each with one judged value.

    Texts pass the same search as documents; what is found in them besides the judged value is left out, and a
    text whose value is no candidate, a null one included, teaches nothing.
    """
    kept = materialize(examples.select("text", "value", "label").withColumn("doc_id", F.monotonically_increasing_id()))
    found = candidates(kept.select("doc_id", "text"))
    judged = kept.select("doc_id", "value", F.col("label").cast("double").alias("label"))
    return with_features(found.join(judged, ["doc_id", "value"]), language)


def train(labelled: DataFrame, per_label: int = TRAINING_FINDINGS) -> PipelineModel | None:
    """A forest fitted to findings with ``FEATURES`` and ``label`` 0 or 1; None without both labels.

    At most ``per_label`` findings of each label are used, those with the smallest hashes, in that
    order and in one partition, so that the forest does not depend on how rows are spread.
    """
    order = [F.xxhash64("value", "before", "after"), F.col("value"), F.col("start")]
    known = [
        labelled.filter(F.col("label") == label).orderBy(*order).limit(per_label)
        .select("label", *FEATURES)
        for label in (0.0, 1.0)
    ]
    sample = materialize(known[0].union(known[1]).coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=40, maxDepth=10, featureSubsetStrategy="onethird", seed=11,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
    )
    return Pipeline(
        stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_features"), forest]
    ).fit(sample)


def classify(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``found`` with ``probability`` of being a secret, rounded to 6 digits.

    Without a model nothing is known of any, and all have 0.5.
    """
    if model is None:
        return found.withColumn("probability", F.lit(0.5))
    scored = model.transform(found)
    return scored.withColumn(
        "probability", F.round(vector_to_array("_probability")[1], 6)
    ).drop("_features", "_raw", "_probability", "_class")


def scan(documents: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """(doc_id, kind, value, start, length, probability, is_secret) of all findings.

    ``documents`` has (doc_id, text) and may have more columns; ``key`` names another column than
    doc_id to tell findings by, here and in the result. Texts are searched whole. The forest is trained on
    ``labelled``, (text, value, label) with 1 for a secret and 0 for none, or else on texts made by rule
    (``findings.labelled_texts``). Repeated rows give repeated findings; null and empty texts and an empty
    table give none; a null doc_id stays null.
    """
    texts = documents.select(F.col(key).alias("doc_id"), "text")
    language = corpus_language(texts)
    found = materialize(with_features(candidates(texts), language))
    examples = labelled_texts(language.row) if labelled is None else labelled
    model = train(labelled_findings(examples, language))
    return classify(found, model).select(
        F.col("doc_id").alias(key),
        "kind",
        "value",
        "start",
        F.length("value").cast("bigint").alias("length"),
        "probability",
        (F.col("probability") >= 0.5).alias("is_secret"),
    )


def redact_rows(documents: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``documents`` scanned and with the secrets of each row replaced by ``mark`` in that row only.

    Rows get a key of their own by being written, so ids may be missing or shared and no group is
    larger than the findings of one text. Findings are replaced where they are, from the last to the
    first; then other copies of their values in the same text: those of fewer than ``COPIED`` characters
    where they are not a part of a longer word, and not if they are letters only, as the same word elsewhere is
    no secret.
    """
    keyed = materialize(documents.withColumn(_KEY, F.monotonically_increasing_id()))
    secrets = (
        scan(keyed, key=_KEY)
        .filter("is_secret")
        .groupBy(_KEY)
        .agg(F.collect_set(F.struct("start", "length", "value")).alias("_spans"))
    )
    text = F.aggregate(
        F.reverse(F.array_sort("_spans")),
        F.col("text"),
        lambda t, s: F.concat(
            F.substring(t, F.lit(1), s["start"].cast("int")),
            F.lit(mark),
            F.substring(t, (s["start"] + s["length"] + 1).cast("int"), F.length(t)),
        ),
    )
    values = F.array_distinct(F.transform("_spans", lambda s: F.struct(s["length"].alias("n"), s["value"].alias("v"))))
    # A mark that stands already is matched first and stays.
    kept, shown = F.lit(rf"\Q{mark}\E|"), F.lit(mark.replace("\\", r"\\").replace("$", r"\$"))

    def copies(value: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        alone = F.concat(F.lit(r"(?<![\p{L}\p{N}])"), quoted, F.lit(r"(?![\p{L}\p{N}])"))
        return F.concat(kept, F.when(F.length(value) >= COPIED, quoted).otherwise(alone))

    telling = F.filter(values, lambda v: (v["n"] >= COPIED) | v["v"].rlike(r"[^\p{L}]"))
    copied = F.reverse(F.array_sort(telling))
    text = F.aggregate(copied, text, lambda t, s: F.regexp_replace(t, copies(s["v"]), shown))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(text)
    joined = keyed.join(secrets, _KEY, "left")
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns])
