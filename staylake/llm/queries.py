"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm import (
    bpe, decontaminate, html_extract, lexical, line_dedup, pii, quality, records, simhash,
    token_counts, topk, warc, whitening)
from staylake.llm.common import table
from staylake.session import run_dir

SIMHASH_SHINGLE_WORDS = 4
SIMHASH_MAX_BITS = 4
TOP_K = 20
MAX_TOKENS = 4096
COMPONENTS = 4
BEST_DOCUMENTS = 10
END_ID = 2


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vid % 20 = 0"), TOP_K)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return bpe.digests(bpe.encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines without those that an earlier document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.contract_columns(line_dedup.dedup_lines(docs))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id", "held_out", "score", "predicted")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the piece vocabulary."""
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.contract_columns(pii.find(table(spark, sf_dir, "documents")))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records of a replica of the pages' WARC files."""
    pages = table(spark, sf_dir, "pages")
    return warc.audit(warc.warc_records(pages), warc.warc_records(warc.damaged_copy(pages)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.contract_columns(simhash.near_duplicates(
        table(spark, sf_dir, "documents"), SIMHASH_SHINGLE_WORDS, SIMHASH_MAX_BITS))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector projected on the four leading whitening components."""
    vectors = whitening.grid_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors, COMPONENTS))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                          BEST_DOCUMENTS)


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as binary records and read back."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = records.write_records(table(spark, sf_dir, "documents"), run_dir(spark, "records"),
                                 lambda: records.word_encoder(vocabulary), END_ID)
    return records.digests(records.read_records(spark, path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_extraction, op2_exact_topk, op3_bpe, op4_line_dedup, op5_quality,
        op6_decontamination, op7_token_counts, op8_pii, op9_warc_fixity, op10_simhash,
        op11_whitening, op12_lexical_search, op13_token_records)}

# The others have no SQL form; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op2_exact_topk": topk.ORACLE_SQL,
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op6_decontamination": decontaminate.ORACLE_SQL,
    "op9_warc_fixity": warc.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
}
