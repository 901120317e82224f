"""The registered queries of this subpackage, at production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import (bag_minhash, chat_format, decontaminate, language_id, line_dedup, packing, pii, prefix_hash,
                           quality, token_counts, vector_codes, warc, whitening)
from citypulse.llm.stage import staged

TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a public SentencePiece BPE vocabulary."""
    docs = _table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_path()).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as JSON records, mapped by schema fingerprint,
    formatted, written, and digested from what was written."""
    said = "\\### Assistant: </turn> ok"
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    records = rows.unionByName(probe).select(
        "conv_id", F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = chat_format.canonical(records, "record", "conv_id")
    return chat_format.read_back(staged(chat_format.format_turns(turns), "op2-formatted"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy duplicate lines of every document."""
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return bag_minhash.classes(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of them is held out of learning."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.remainder("doc_id", 4) == 2
    learned = language_id.learn(docs.where(~held))
    out = language_id.predict(docs.select("doc_id", "text"), learned, ["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of them is held out of learning."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = language_id.remainder("doc_id", 3) == 1
    labels = _table(spark, sf_dir, "labels").where(~held)
    out = quality.score(docs, quality.learn(docs, labels), ["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of four permitted lengths (bytes)."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text and its successor."""
    return prefix_hash.fingerprints(_table(spark, sf_dir, "documents"))


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document."""
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, all spans."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    base = pii.base_only(F.col("spans"))
    counts = [pii.how_many(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: 16 parts, 64 entries, 2 Lloyd rounds."""
    return vector_codes.coded(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on the 4 leading components."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_chat_format, op3_line_dedup, op4_bag_minhash, op5_language_id, op6_quality, op7_warc,
    op8_best_fit_packing, op9_prefix_hash, op10_latent_decontamination, op11_pii, op12_vector_codes, op13_whitening)}

# Lloyd's rounds written out: a round's nearest entries by all distances, ties to
# the lower index, then floored means; entries without parts stay.
_PARTS = "generate_series(0, 15)"


def _lloyd(k: int) -> str:
    return f"""
near{k} AS (
    SELECT row, p, part, min_by(e, d * 64 + e) AS e, min(d) AS d FROM (
        SELECT s.row, s.p, s.part, b.e,
               list_sum(list_transform(list_zip(s.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts s JOIN book{k} b USING (p)) GROUP BY row, p, part)"""


def _book(k: int) -> str:
    return f"""
mean{k} AS (
    SELECT p, e, list(m ORDER BY i) AS entry FROM (
        SELECT p, e, i, floor(sum(part[i])::DOUBLE / count(*))::BIGINT AS m
        FROM near{k - 1}, LATERAL (SELECT unnest(generate_series(1, len(part))) AS i) GROUP BY p, e, i) GROUP BY p, e),
book{k} AS (
    SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{k - 1} b LEFT JOIN mean{k} m USING (p, e))"""


ORACLE_SQL: dict[str, str] = {"op12_vector_codes": f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
           list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS (
    SELECT row, p, list_slice(x, p * (len(x) // 16) + 1, (p + 1) * (len(x) // 16)) AS part
    FROM kept, LATERAL (SELECT unnest({_PARTS}) AS p)),
book0 AS (SELECT p, row - 1 AS e, part AS entry FROM parts WHERE row <= 64),
{_lloyd(0)},
{_book(1)},
{_lloyd(1)},
{_book(2)},
{_lloyd(2)},
codes AS (
    SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY row),
labelled AS (SELECT vec_id, label, code, error FROM codes JOIN kept USING (row)),
per_label AS (SELECT label, sum(error)::BIGINT AS label_error FROM labelled GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM labelled l JOIN per_label t ON l.label IS NOT DISTINCT FROM t.label"""}
