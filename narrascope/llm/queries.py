"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrascope.functions.bounds import shared_path
from narrascope.llm.alignment import align_tokenizers
from narrascope.llm.bpe import encode_decode
from narrascope.llm.classifier import score_documents, train_classifier
from narrascope.llm.collocations import collocations
from narrascope.llm.common import col, keyed
from narrascope.llm.exact_dedup import exact_dedup
from narrascope.llm.html_extract import extract_main_text
from narrascope.llm.line_dedup import line_dedup
from narrascope.llm.packing import pack_documents
from narrascope.llm.quality_rules import quality_rules
from narrascope.llm.simhash import simhash_groups
from narrascope.llm.substring_dedup import substring_dedup
from narrascope.llm.token_counts import token_counts
from narrascope.llm.token_files import token_index, write_token_files

_BYTES, _WORDS, _PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _with_ids(docs: DataFrame, operator: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows of an operator, given documents and the name of their key, with the real ``doc_id``.

    Where ids are not unique the keys are numbers of rows, and each row's id is joined to it.
    """
    docs, row = keyed(docs, "doc_id")
    found = operator(docs, row)
    if row == "doc_id":
        return found.withColumnRenamed("row_key", "doc_id")
    return found.join(docs.select(col(row).alias("row_key"), "doc_id"), "row_key").drop("row_key")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    carry = {"digest": lambda body: F.unhex(F.sha2(body, 256))}
    found = exact_dedup(_documents(spark, sf_dir), carry=carry)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ids(_documents(spark, sf_dir), line_dedup).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path(_BYTES)).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(_BYTES)
    return _with_ids(_documents(spark, sf_dir), lambda docs, row: token_counts(docs, path, row)).select(
        "doc_id", "n_bytes", "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(_WORDS)
    return _with_ids(_documents(spark, sf_dir), lambda docs, row: encode_decode(docs, path, row)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), public_tokenizers.path(_BYTES), path)
    return token_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    rest, spans = substring_dedup(docs)
    return rest.select("doc_id", F.size(spans).alias("n_passages"), F.col(spans).alias("spans"), "text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _with_ids(_documents(spark, sf_dir), quality_rules)
    return found.select("doc_id", *[c for c in found.columns if c != "doc_id"])


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = _documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = train_classifier(docs, labels, usable=fold != 0)
    scores = _with_ids(docs, lambda docs, row: score_documents(docs, machine, row))
    # Rows without an id have no label, so they are never trained on.
    return scores.select(
        "doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path(_BYTES), public_tokenizers.path(_PIECES)
    aligned = lambda docs, row: align_tokenizers(docs, a, b, row, digest=True)[0]
    return _with_ids(_documents(spark, sf_dir), aligned).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url"])


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))
