"""From raw documents to packed training sequences, in five stages.

Each stage takes and returns the rows of ``documents`` that are left, with the columns they
have; the last one returns the packed pieces. Stages are run one after another, each on the
Parquet files of the one before.

1. quality rules: documents that the combined rules reject go
2. exact dedup: of equal texts the document with the smallest id stays
3. SimHash near-dedup: of each component of documents whose fingerprints, of shingles of three
   words, differ in at most three bits the one with the smallest id stays
4. substring dedup: passages that stand elsewhere are cut out; documents stay, ``n_chars``
   (where there is such a column) is that of the text left
5. best-fit packing: pieces of at most 1024 tokens and their places in sequences

Nulls in any column, empty and very long texts, repeated rows, empty tables and further
columns are handled as the operators say; columns are passed on as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrascope.functions.bounds import shared_path
from narrascope.llm.exact_dedup import drop_exact_copies
from narrascope.llm.packing import pack_documents
from narrascope.llm.quality_rules import drop_low_quality
from narrascope.llm.simhash import drop_near_copies
from narrascope.llm.substring_dedup import substring_dedup
from narrascope.shipping import ship_packages

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_packages(spark)
    return drop_low_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_packages(spark)
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_packages(spark)
    return drop_near_copies(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_packages(spark)
    rest, spans = substring_dedup(docs)
    if "n_chars" in docs.columns:
        cut = F.size(spans) > 0
        length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        rest = rest.withColumn("n_chars", F.when(cut, length).otherwise(F.col("n_chars")))
    return rest.drop(spans)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_packages(spark)
    pieces = pack_documents(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumnRenamed("id", "doc_id").drop("row_key")


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the estimated rules, the fingerprints, the chunks or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
