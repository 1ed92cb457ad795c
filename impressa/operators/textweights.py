"""Term weights in long form: counts, hashed counts, inverse document frequency, unit length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.functions.hashing import key_hash
from impressa.operators.ordering import number_rows
from impressa.session import materialize

# So many of the most frequent terms are broadcast, some 100 bytes each. Among the 1.56 million terms of
# 60,000 documents they have 94 of 100 counts.
HEAD_TERMS = 1 << 19


def term_counts(df: DataFrame, doc_id: str, tokens: Column) -> DataFrame:
    """(doc, term, tf). The token lists are counted map-side before the shuffle."""
    return (
        df.select(doc_id, F.explode(tokens).alias("term"))
        .groupBy(doc_id, "term")
        .agg(F.count("*").alias("tf"))
    )


def hashed_counts(counts: DataFrame, doc_id: str, buckets: int, seed: int = 0) -> DataFrame:
    """(doc, bucket, tf): counts added up in hash buckets."""
    bucket = F.pmod(key_hash(seed, "term"), F.lit(buckets)).cast("int")
    return counts.groupBy(doc_id, bucket.alias("bucket")).agg(F.sum("tf").alias("tf"))


def inverse_document_frequency(documents: Column, containing: Column) -> Column:
    return F.ln((documents + 1) / (containing + 1))


def fit_vocabulary(
    counts: DataFrame,
    documents: DataFrame,
    doc_id: str,
    weight: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """(term, term_index, df, idf): all terms by falling frequency, ties in term order.

    With ``size`` only as many of the most frequent terms.

    ``counts`` holds the terms of ``documents``, which has one row per document. With ``weight`` a
    document stands for that many rows (impressions of an item), counted without repeating its
    text; counts of documents without a weight are left out then.
    """
    if weight is None:
        total = documents.agg(F.count("*").alias("n"))
        sums = [F.sum("tf").alias("n"), F.count("*").alias("df")]
        fitted = counts
    else:
        total = documents.agg(F.sum(weight).alias("n"))
        sums = [F.sum(F.col("tf") * F.col(weight)).alias("n"), F.sum(weight).alias("df")]
        fitted = counts.join(documents.select(doc_id, weight), doc_id)
    totals = fitted.groupBy("term").agg(*sums)
    ranked = number_rows(totals, [F.desc("n"), "term"], "term_index")
    idf = inverse_document_frequency(total.scalar(), F.col("df"))
    kept = ranked if size is None else ranked.filter(F.col("term_index") < size)
    return materialize(kept.select("term", "term_index", "df", idf.alias("idf")))


def weighted_terms(
    counts: DataFrame, vocabulary: DataFrame, doc_id: str, parts: int | None = None
) -> DataFrame:
    """(doc, term, term_index, tf, weight) with weight = tf * idf; unknown terms vanish.

    The most frequent terms, ``HEAD_TERMS`` of them, are broadcast, so that their counts stay where they
    are; only counts of rarer terms are shuffled. A term behind so many more frequent ones is never
    frequent enough to fill a task. Where counts lie in ``parts`` tasks by document, the rest is brought
    to the same tasks.
    """
    known = vocabulary.select("term", "term_index", "idf")
    head = F.broadcast(known.filter(F.col("term_index") < HEAD_TERMS))
    tail = known.filter(F.col("term_index") >= HEAD_TERMS)
    joined = counts.join(head, "term")
    if not tail.isEmpty():
        rare = counts.join(head, "term", "left_anti").join(tail, "term")
        rare = rare if parts is None else rare.repartition(parts, doc_id)
        joined = joined.unionByName(rare)
    return joined.select(
        doc_id, "term", "term_index", "tf", (F.col("tf") * F.col("idf")).alias("weight")
    )


def document_vectors(weighted: DataFrame, doc_id: str) -> DataFrame:
    """(doc, terms array<struct<term_index, weight>>) scaled to length 1.

    One row per document, at most its distinct terms long. An all-zero document stays all zero.
    """
    entry = F.struct("term_index", "weight")
    gathered = weighted.groupBy(doc_id).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"),
    )
    unit = F.coalesce(F.nullif(F.col("length"), F.lit(0.0)), F.lit(1.0))
    scaled = F.transform(
        "entries",
        lambda e: F.struct(
            e["term_index"].alias("term_index"), (e["weight"] / unit).alias("weight")
        ),
    )
    return gathered.select(doc_id, scaled.alias("terms"))
