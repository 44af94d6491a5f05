"""The registered queries of the subpackage: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.llm import (bpe, decontam, fim, hard_negatives, licenses, lm, ngram_join, quality, secret_ledger, simhash,
                          token_files, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with their best window."""
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from grammar-compressed files."""
    found = token_files.tokenize_to_files(_table(spark, sf_dir, "documents"),
                                          public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as records of a chunked archive table, read back."""
    found = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op5_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact unigram and filter-based bigram log probability of every document."""
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document."""
    found = quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "stratum", "rejected_by")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document's restored text."""
    return toxicity.score_texts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.expr("lpad(lower(hex(fp)), 16, '0')").alias("fingerprint"), "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in documents, with their best window."""
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def _span_list(spans: str) -> str:
    """Comma-joined kind:start:end of a span array."""
    names = ", ".join(f"'{r.name}'" for r in secret_ledger.RULES)
    return f"array_join(transform({spans}, s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')"


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, through a ledger of its blobs."""
    found = secret_ledger.scan(_table(spark, sf_dir, "documents"))
    base = "filter(spans, s -> s.kind < 3)"  # assign, access, hex
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = {k})) as bigint)").alias(f"n_{r.name}")
          for k, r in enumerate(secret_ledger.RULES[:3])],
        F.expr(f"sha2({_span_list(base)}, 256)").alias("base_sha256"),
        F.expr(_span_list("spans")).alias("spans"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and similarity component of every document."""
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive of the embeddings."""
    rows = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives.mine(rows)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, as digests."""
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select("_row.doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                       F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"), "fim.restored_sha256")


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_token_files, op3_warc, op4_byte_bpe, op5_bloom_lm, op6_quality_rules, op7_toxicity,
    op8_simhash_near_dedup, op9_license_scan, op10_secret_ledger, op11_ngram_join, op12_hard_negatives,
    op13_fill_in_middle)}
ORACLE_SQL: dict[str, str] = {
    "op3_warc": f"""
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p),
    r AS (SELECT *, payload_bytes >= {warc.MIN_REVISIT} AND page_id > first_id AS again FROM f)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN first_id END AS refers_to FROM r""",
    "op6_quality_rules": quality.oracle_sql(),
    "op9_license_scan": licenses.oracle_sql(),
    "op10_secret_ledger": secret_ledger.oracle_sql(),
    "op12_hard_negatives": hard_negatives.oracle_sql(),
    "op13_fill_in_middle": fim.oracle_sql(),
}
