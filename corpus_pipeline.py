"""Corpus preparation: language, near-duplicates, secrets, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.llm import bpe, language, minhash, mixing, secret_scan
from impressa.session import delete_at_end, discard, materialize, scratch_path

# A document goes if more than this share of its words fits none of the learned languages.
MOST_UNKNOWN = 0.5
# Key of a row within the stage that removes near-duplicates.
_KEY = "_row_key"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written mostly in languages that the corpus is labelled with.

    Null texts and texts without letters go, as does everything where no language is labelled. Rows are
    judged one by one, so repeated rows and null ids need no care; other columns may have any name.
    """
    # Columns travel under other names, so that they may be called like those of the operator.
    held = {f"_held{i}": c for i, c in enumerate(docs.columns)}
    renamed = docs.select("text", *[F.col(f"`{c}`").alias(name) for name, c in held.items()])
    known = language.identify(renamed, language.learn(docs), carry=list(held), unknown=True)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("unknown") <= MOST_UNKNOWN)
    return known.filter(kept).select(*[F.col(name).alias(c) for name, c in held.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id.

    Rows are compared by a key of their own, so that repeated rows, rows that share a doc_id and rows
    without one are each judged by their own text. Keys rise with doc_id, null ids last, then by text.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    keyed = materialize(docs.orderBy(*order).withColumn(_KEY, F.monotonically_increasing_id()))
    found = minhash.near_duplicates(keyed.select(_KEY, "text"), id_column=_KEY)
    return keyed.join(found.filter(~F.col("kept")).select(_KEY), _KEY, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark, each row's own only.

    Null and empty texts stay as they are; rows that are repeated or share an id are each changed by
    their own findings; an empty table stays empty.
    """
    return secret_scan.redact_rows(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, each row by a key of its own.

    A null source is a source; null and empty texts have no words and go; repeated rows each count; an
    empty table stays empty; other columns may have any name.
    """
    return mixing.mixed_copies(docs, mixing.word_count(F.col("text")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens): the byte-level BPE ids of every text of the mix.

    A null or empty text has no ids; rows are encoded one by one; further columns are left out.
    """
    encoded = bpe.encode_documents(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        carry=("doc_id", "lang", "source"),
    )
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

# Mixtures by EM, MinHash, forests and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; read copies are deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        result, path = stage(spark, docs, sf_dir), scratch_path(spark)
        result.write.parquet(path)
        delete_at_end(spark, path)
        if before is not None:
            discard(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return docs
