"""Registered queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impressa.llm import (
    bpe,
    language,
    minhash,
    mixing,
    negatives,
    piecewise,
    prefixes,
    secret_scan,
    sharding,
    topk,
    toxicity,
    trie,
    warc,
)
from impressa.session import delete_at_end, materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- 1 near-duplicates


@query("op1_minhash")
def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


# ---------------------------------------------------------------- 3 WARC


@query(
    "op3_warc",
    r"""
    WITH raw AS (
      SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
             octet_length(encode(coalesce(html, ''))) AS payload_bytes
      FROM pages),
    first AS (SELECT digest, min(page_id) AS first_id FROM raw WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, raw.digest AS payload_digest,
           CASE WHEN coalesce(page_id <> first_id, false) THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM raw LEFT JOIN first USING (digest)""",
)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Length and digest are taken from the payload that was read; a revisit has its header's."""
    path = scratch_path(spark)
    warc.write_warc(warc.page_records(table(spark, folder, "pages")), path)
    delete_at_end(spark, path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    number = lambda c: F.nullif(page(c), F.lit("")).cast("bigint")
    read = F.col("payload").isNotNull()
    return warc.read_warc(spark, path).select(
        number("record_id").alias("page_id"),
        F.when(read, F.length("payload").cast("bigint"))
        .otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(read, F.sha2("payload", 256))
        .otherwise(F.regexp_replace("payload_digest", "^sha256:", ""))
        .alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


# ---------------------------------------------------------------- 4 exact top-k search


@query(
    "op4_topk",
    """
    WITH ints AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM ints q JOIN ints c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
      WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
)
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    found = topk.top_k_search(vectors, F.col("id") % 50 == 0, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


# ---------------------------------------------------------------- 5 mixing


@query(
    "op5_mixing",
    r"""
    WITH docs AS (
      SELECT doc_id, source,
             coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             CAST('0x' || substr(md5(concat_ws(':', '17', doc_id::VARCHAR)), 1, 15) AS BIGINT) AS k
      FROM documents),
    sources AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             [5.0::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM docs GROUP BY source),
    ranked AS (
      SELECT *, 2 * source_size::DOUBLE AS lim, 2 * source_size::DOUBLE / w AS full_at,
             row_number() OVER (ORDER BY 2 * source_size::DOUBLE / w, source NULLS LAST) AS n
      FROM sources),
    rests AS (
      SELECT a.full_at, a.n,
             (SELECT 1.5::DOUBLE * sum(source_size) FROM sources)
               - coalesce((SELECT sum(b.lim) FROM ranked b WHERE b.n < a.n), 0) AS rest,
             (SELECT sum(b.w) FROM ranked b WHERE b.n >= a.n) AS rest_w
      FROM ranked a),
    level AS (SELECT rest, rest_w FROM rests WHERE rest <= full_at * rest_w ORDER BY n LIMIT 1),
    targets AS (
      SELECT source, source_size,
             coalesce(least(lim, w * (SELECT rest FROM level) / (SELECT rest_w FROM level)), lim) AS target
      FROM ranked),
    placed AS (
      SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
      FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE
             (budget // source_size) * size
             + greatest(0, least(size, budget - (budget // source_size) * source_size - before))
           END::BIGINT AS taken
    FROM placed""",
)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), mixing.word_count(F.col("text")))
    return mixed.drop("source")


# ---------------------------------------------------------------- 6 sharding


@query("op6_sharding")
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    documents = materialize(
        table(spark, folder, "documents").select(
            "doc_id",
            "source",
            "lang",
            (F.length(text) + 16).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
    )
    dimensions = {
        "source": sharding.text_number(F.col("source")),
        "lang": sharding.text_number(F.col("lang")),
        "size": sharding.magnitude(F.col("size")),
    }
    sharded = sharding.assign_shards(documents, dimensions, 40, ["doc_id", "text_crc32", "size"], bits=5)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# ---------------------------------------------------------------- 2 byte-level BPE


@query("op2_bpe")
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


# ---------------------------------------------------------------- 7 document fingerprints


@query("op7_piecewise_hash")
def op7_piecewise_hash(spark: SparkSession, folder: str) -> DataFrame:
    return piecewise.compare_with_next(table(spark, folder, "documents"))


# ---------------------------------------------------------------- 8 language


@query("op8_language")
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Learned from the documents whose id's CRC-32 does not leave remainder 1 by 3."""
    documents = table(spark, folder, "documents")
    held_out = language.fold("doc_id") == 1
    model = language.learn(documents.filter(~held_out))
    predicted = language.identify(documents, model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


# ---------------------------------------------------------------- 9 token counts

TOKEN_LIMIT = 4096


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = prefixes.token_totals(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


# ---------------------------------------------------------------- 10 secrets


@query("op10_secrets")
def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The findings left when false positives are removed; of the value only a digest is shown."""
    found = secret_scan.scan(table(spark, folder, "documents"))
    return found.filter("is_secret").select(
        "doc_id", "kind", "start", "length", F.sha2("value", 256).alias("value_sha256"), "probability"
    )


# ---------------------------------------------------------------- 11 conversation trie


@query(
    "op11_trie",
    r"""
    WITH RECURSIVE ordered AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS position
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT conv_id,
             list_reduce(list_concat([4294967295::BIGINT],
               flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda s, e: CASE WHEN e >= 0 THEN xor(s, e)
                                 WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END) AS inverse
      FROM (SELECT DISTINCT conv_id FROM ordered)),
    taken AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(inverse, 4294967295) % 6 AS h FROM convs),
    sequences AS (
      SELECT t.conv_id,
             list_concat(
               coalesce((SELECT list({'role': role, 'text': text} ORDER BY position)
                         FROM ordered o WHERE o.conv_id = t.base AND position <= h), []),
               coalesce((SELECT list({'role': role, 'text': text} ORDER BY position)
                         FROM ordered o WHERE o.conv_id = t.conv_id AND position > h), [])) AS path
      FROM taken t),
    members AS (
      SELECT conv_id, d AS depth, len(path) = d AS ends, path[:d] AS path
      FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM sequences)),
    nodes AS (
      SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), ''))
               AS ends_sha256
      FROM members GROUP BY depth, path),
    kids AS (
      SELECT n.depth, n.path, count(k.depth) AS n_children
      FROM nodes n LEFT JOIN nodes k ON k.depth = n.depth + 1 AND k.path[:n.depth] = n.path GROUP BY 1, 2),
    below AS (
      SELECT n.depth, n.path, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves,
             sum((u.n_convs - 1) * coalesce(length(u.path[-1].text), 0)) AS saved_tokens
      FROM nodes n JOIN nodes u ON u.depth >= n.depth AND u.path[:n.depth] = n.path
      JOIN kids k ON k.depth = u.depth AND k.path = u.path GROUP BY 1, 2)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
           k.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
           b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN kids k ON k.depth = n.depth AND k.path = n.path
    JOIN below b ON b.depth = n.depth AND b.path = n.path
    LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]""",
)
def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    conversations, turns = trie.rebuilt(trie.ordered_turns(table(spark, folder, "conversations")))
    return trie.prefix_trie(conversations, turns)


# ---------------------------------------------------------------- 12 toxicity

TOXIC_SCORE = 0.3


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learned from the labelled documents whose id's CRC-32 does not leave remainder 2 by 4."""
    documents = table(spark, folder, "documents")
    held_out = toxicity.fold("doc_id") == 2
    model = toxicity.learn(documents.filter(~held_out).select("doc_id", "text"), table(spark, folder, "labels"))
    scored = toxicity.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted")
    )


# ---------------------------------------------------------------- 13 hard negatives


@query(
    "op13_hard_negatives",
    """
    WITH ints AS (
      SELECT row_number() OVER () AS row, vec_id,
             (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_inner_product(a.v, c.v)::BIGINT AS score
      FROM ints a JOIN ints c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
      WHERE a.vec_id % 50 = 0),
    positives AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE same) WHERE place <= 5),
    ranked AS (
      SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
             p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.row, p.place ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
      FROM positives p JOIN scored n ON p.row = n.row AND NOT n.same
       AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM ranked WHERE rank <= 3""",
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.integer_rows(table(spark, folder, "embeddings"), "vec_id", "embedding", moved)
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0)
