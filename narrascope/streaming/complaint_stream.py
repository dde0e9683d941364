"""The narrow steps on a stream: filter, clean and chunk complaints as files arrive.

The operators are the batch ones. They keep no state, so no watermark is needed and a
restart continues from the checkpoint; the file sink makes each batch visible once.
CSV files are read per batch; results over all batches are in ``running``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from narrascope.functions.embedding import Encoder
from narrascope.operators.chunking import chunk_recursive
from narrascope.plans.preprocess import cleaned_complaints
from narrascope.schema import RAW_SCHEMA
from narrascope.sources.chunk_store import with_embeddings
from narrascope.sources.complaints import parsed_csv
from narrascope.sources.csv_blocks import located


def read_complaint_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_csv_stream(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = RAW_SCHEMA,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append arriving CSV files to a Parquet folder, corrupt records with their text.

    A file belongs to one batch whole, so records are cut as by ``read_csv``. A batch has a
    folder of its own, which a repeated batch replaces. All that is available now, then it stops.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = located(reader.text(path))

    def append(batch: DataFrame, number: int) -> None:
        rows = parsed_csv(batch, schema, keep_corrupt=True)
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def chunk_stream(
    complaints: DataFrame,
    chunker: Callable[..., DataFrame] = chunk_recursive,
    factory: Callable[[], Encoder] | None = None,
    tasks: int | None = None,
    **options,
) -> DataFrame:
    """Chunks of arriving complaints, with vectors when an encoder is given.

    ``tasks`` deals complaints out first, for a stream of few large files.
    """
    if tasks:
        complaints = complaints.repartition(tasks)
    chunks = chunker(cleaned_complaints(complaints), **options)
    return chunks if factory is None else with_embeddings(chunks, factory)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None
) -> StreamingQuery:
    """Start writing to Parquet; everything available now is processed, then it stops.

    Embedded chunks written with ``partition_by="product_category"`` add to a chunk store.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
