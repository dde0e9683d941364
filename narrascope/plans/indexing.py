"""Cleaned complaints to a chunk store: sample, chunk, embed, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.functions.embedding import Encoder, hashed_words
from narrascope.operators.chunking import chunk_recursive
from narrascope.operators.sampling import stratified_sample
from narrascope.schema import CHUNK_OVERLAP, CHUNK_SIZE, SAMPLE_SEED, SAMPLE_SIZE
from narrascope.sources.chunk_store import write_store
from narrascope.sources.complaints import load_cleaned


def build_store(
    spark: SparkSession,
    cleaned_path: str,
    store_path: str,
    *,
    sample_size: int = SAMPLE_SIZE,
    chunk_size: int = CHUNK_SIZE,
    chunk_overlap: int = CHUNK_OVERLAP,
    seed: int = SAMPLE_SEED,
    factory: Callable[[], Encoder] = hashed_words,
    chunker: Callable[..., DataFrame] = chunk_recursive,
) -> DataFrame:
    """Write a store from a written cleaned table and return one row of run statistics."""
    cleaned = load_cleaned(spark, cleaned_path)
    # Chunks are written before they are embedded, as they are counted, checked and stored.
    drawn = Observation("drawn")
    sample = stratified_sample(cleaned, sample_size, seed).observe(drawn, F.count("*").alias("n"))
    chunks = pinned(chunker(sample, chunk_size, chunk_overlap), "chunks")
    indexed = write_store(chunks, store_path, factory)
    return run_statistics(spark, drawn.get["n"], chunks.count(), indexed, store_path)


def run_statistics(
    spark: SparkSession, sampled: int, chunks: int, indexed: int, store_path: str
) -> DataFrame:
    """Rows drawn, chunks cut from them, rows read back from the store, and its place.

    Each number is counted where its rows are made, so that a loss between two steps shows.
    """
    return spark.createDataFrame(
        [(sampled, chunks, indexed, store_path)],
        "sampled_complaints long, chunks long, indexed long, persist_dir string",
    )
