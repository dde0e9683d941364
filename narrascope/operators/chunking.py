"""From cleaned narratives to one row per chunk, traceable to the source complaint.

Chunking is a narrow step: the position of a chunk and the number of its siblings come
from the array of chunks itself, so no window and no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrascope.functions.splitting import split_fixed, split_recursive
from narrascope.functions.text import has_text, text_or_empty
from narrascope.schema import (
    CHUNK_METADATA,
    CHUNK_OVERLAP,
    CHUNK_SCHEMA,
    CHUNK_SEPARATORS,
    CHUNK_SIZE,
    CLEANED,
    COMPLAINT_ID,
)


def _chunk_rows(df: DataFrame, pieces: Column, text: str) -> DataFrame:
    metadata = [
        text_or_empty(F.col(f"`{source}`") if source in df.columns else F.lit(None)).alias(name)
        for name, source in CHUNK_METADATA.items()
    ]
    exploded = (
        df.where(has_text(F.col(text)))
        .select(*metadata, pieces.alias("pieces"))
        .select("*", F.posexplode("pieces").alias("chunk_index", "text"))
    )
    complaint = F.coalesce(F.nullif(F.col("complaint_id"), F.lit("")), F.lit("unknown"))
    return exploded.select(
        F.concat_ws("-", complaint, F.col("chunk_index")).alias("chunk_id"),
        "text",
        *CHUNK_METADATA,
        "chunk_index",
        F.size("pieces").alias("total_chunks"),
    ).select(*CHUNK_SCHEMA.fieldNames())


def chunk_recursive(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = tuple(CHUNK_SEPARATORS),
    text: str = CLEANED,
) -> DataFrame:
    """Chunks cut at the coarsest fitting separator; blank text gives no chunk."""
    return _chunk_rows(df, split_recursive(F.col(text), size, overlap, separators), text)


def chunk_fixed(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    text: str = CLEANED,
) -> DataFrame:
    """Chunks cut at character positions; blank text gives no chunk."""
    return _chunk_rows(df, split_fixed(F.col(text), size, overlap), text)


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    """One row: chunks, complaints, chunks per complaint, mean and median chunk length.

    Complaints are counted by their first chunk and lengths are counted per length
    before the median, so nothing is shuffled per complaint.
    """
    lengths = chunks.groupBy(F.length("text").alias("characters")).agg(
        F.count("*").alias("n"), F.count_if(F.col("chunk_index") == 0).alias("firsts")
    )
    n, characters = F.sum("n"), F.col("characters")
    return lengths.agg(
        F.coalesce(n, F.lit(0)).alias("chunks"),
        F.coalesce(F.sum("firsts"), F.lit(0)).alias("complaints"),
        F.try_divide(n, F.sum("firsts")).alias("chunks_per_complaint"),
        F.try_divide(F.sum(characters * F.col("n")), n).alias("mean_length"),
        F.percentile(characters, F.lit(0.5), F.col("n")).alias("median_length"),
    )


def trace_chunks(chunks: DataFrame, complaints: DataFrame) -> DataFrame:
    """Chunks with the columns of the complaint they were cut from.

    Chunks of complaints without an id cannot be traced; they keep null in those columns.
    They are not joined, as each would meet every other complaint without an id.
    """
    sources = complaints.select(
        *[
            F.col(f"`{c}`").alias("source_id" if c == COMPLAINT_ID else c)
            for c in complaints.columns
        ]
    )
    known = F.coalesce(F.col("complaint_id"), F.lit("")) != ""
    traced = chunks.where(known).join(
        sources.where(F.col("source_id") != ""), F.col("complaint_id") == F.col("source_id"), "left"
    )
    return traced.drop("source_id").unionByName(chunks.where(~known), allowMissingColumns=True)


def repeated_ids(chunks: DataFrame) -> DataFrame:
    """Chunk ids that occur more than once; empty for a valid chunk table.

    Complaints without an id all count as ``unknown``, so their chunk ids may repeat.
    """
    return chunks.groupBy("chunk_id").agg(F.count("*").alias("rows")).where("rows > 1")
