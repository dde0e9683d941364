"""The vector table: chunks with embeddings as Parquet, laid out by category.

A question about one category reads that category's directory only. Vectors are stored at
unit length. A store is a folder of snapshots: a new version is written aside and then takes
the place of the old one at once, so a failure leaves the old one as it was. ``update_store``
embeds only chunks that are new or changed: a version may name several parts, and lists of
chunks of older parts that are gone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.functions.bounds import pinned, small_side
from narrascope.functions.embedding import Encoder, embed, hashed_words
from narrascope.operators.chunking import repeated_ids
from narrascope.operators.retrieval import assign_cells
from narrascope.schema import CATEGORY, CHUNK_SCHEMA, EMBED_BATCH, STORE_SCHEMA
from narrascope.sources.snapshots import forget, latest, new_part, publish

# An empty partition value cannot be told from a missing one when it is read back.
_EMPTY_CATEGORY = "(empty)"
_SALTS = 16
#: A version with more parts is written anew, without embedding anything.
_MOST_PARTS = 8


def with_embeddings(
    chunks: DataFrame,
    factory: Callable[[], Encoder] = hashed_words,
    batch_size: int = EMBED_BATCH,
) -> DataFrame:
    return chunks.withColumn("embedding", embed(F.col("text"), factory, batch_size))


def write_store(
    chunks: DataFrame,
    path: str,
    factory: Callable[[], Encoder] = hashed_words,
    batch_size: int = EMBED_BATCH,
) -> int:
    """Embed chunks, write the store and return the number of chunks in it.

    Chunk texts are rebalanced by category and a salt before they are embedded: small
    partitions are merged and large ones split, a category of any weight is spread over
    many tasks, long documents do not hold one task back, and vectors, several times the
    size of the texts, are written by the task that computes them.
    Repeated chunk ids are an error, found before an older store is touched; first chunks
    alone show them.
    """
    spark = chunks.sparkSession
    _unique(chunks.where(F.col("chunk_index") == 0))
    part = new_part(path)
    _write_part(with_embeddings(_even(chunks), factory, batch_size), part)
    _publish(spark, path, [part], [], _identity(spark, factory))
    return read_store(spark, path).count()


def _even(chunks: DataFrame) -> DataFrame:
    """Chunks dealt out by category and salt, their category under its stored name."""
    named = F.when(F.col(CATEGORY) == "", F.lit(_EMPTY_CATEGORY)).otherwise(F.col(CATEGORY))
    salt = F.pmod(F.xxhash64("chunk_id"), F.lit(_SALTS))
    return chunks.withColumns({CATEGORY: named, "_salt": salt}).hint("rebalance", CATEGORY, "_salt").drop("_salt")


def _write_part(stored: DataFrame, part: str) -> None:
    stored.write.partitionBy(CATEGORY).parquet(part)


def _publish(spark: SparkSession, path: str, parts: list[str], gone: list[tuple[int, str]], identity) -> None:
    name = lambda part: part.rsplit("/", 1)[-1]
    told = {"parts": [name(p) for p in parts], "gone": [(n, name(p)) for n, p in gone], "encoder": list(identity)}
    publish(spark, path, told)
    forget(spark, path)


def _digest() -> F.Column:
    """Of all that a chunk is, its text and metadata, in 128 bits."""
    return F.md5(F.to_json(F.struct(*CHUNK_SCHEMA.fieldNames()), {"ignoreNullFields": "false"}))


def update_store(
    chunks: DataFrame,
    path: str,
    factory: Callable[[], Encoder] = hashed_words,
    batch_size: int = EMBED_BATCH,
) -> tuple[int, int]:
    """Make a store hold exactly ``chunks``; return how many were embedded and how many went.

    Only chunks that the last version does not hold as they are pass the encoder. They become a
    part of the new version, and ids of chunks that are gone or changed are listed for the older
    parts. The encoder has to be the store's. Without a store all chunks are written.
    """
    spark = chunks.sparkSession
    told = latest(spark, path)
    if told is None:
        return write_store(chunks, path, factory, batch_size), 0
    _same_encoder(told, _identity(spark, factory))
    _unique(chunks.where(F.col("chunk_index") == 0))
    asked = chunks.select(*CHUNK_SCHEMA.fieldNames()).withColumn("_digest", _digest())
    held = read_store(spark, path).select("chunk_id", _digest().alias("_digest"))
    # Ids and digests of both sides, written once; texts and vectors stay where they are.
    held = pinned(held, "held")
    fresh = asked.join(held, ["chunk_id", "_digest"], "left_anti").drop("_digest")
    went = pinned(held.join(asked.select("chunk_id", "_digest"), ["chunk_id", "_digest"], "left_anti").select("chunk_id"), "went")
    part, gone = new_part(path), new_part(path)
    _write_part(with_embeddings(_even(fresh), factory, batch_size), part)
    went.write.parquet(gone)
    parts = [f"{path}/{p}" for p in told["parts"]]
    lists = [(n, f"{path}/{p}") for n, p in told["gone"]] + [(len(parts), gone)]
    added, removed = spark.read.schema(STORE_SCHEMA).parquet(part).count(), went.count()
    _publish(spark, path, [*parts, part], lists, told["encoder"])
    if len(parts) >= _MOST_PARTS:
        compact_store(spark, path)
    return added, removed


def compact_store(spark: SparkSession, path: str) -> None:
    """Write the last version as one part. Vectors are copied."""
    told, part = latest(spark, path), new_part(path)
    _write_part(_even(read_store(spark, path)), part)
    _publish(spark, path, [part], [], told["encoder"])


def _identity(spark: SparkSession, factory: Callable[[], Encoder]) -> tuple[str, int]:
    """Name of an encoder and the length of its vectors, from one text encoded in a task."""
    name = getattr(factory, "name", None) or getattr(factory, "__qualname__", type(factory).__qualname__)
    probe = spark.range(1).select(F.size(embed(F.lit("a"), factory)).alias("dim"))
    return name, probe.head().dim


def open_store(
    spark: SparkSession, path: str, factory: Callable[[], Encoder] = hashed_words
) -> DataFrame:
    """``read_store`` for questions to be embedded by ``factory``, which has to be the store's.

    Encoders are told apart by ``factory.name``, or its qualified name, and vector length.
    """
    _same_encoder(latest(spark, path), _identity(spark, factory))
    return read_store(spark, path)


def _same_encoder(told: dict | None, asking: tuple[str, int]) -> None:
    if told is None or tuple(told["encoder"]) != asking:
        written = told and tuple(told["encoder"])
        raise ValueError(f"the store was written by encoder {written}, questions come from {asking}")


def _unique(chunks: DataFrame) -> None:
    repeated = repeated_ids(chunks).limit(5).collect()
    if repeated:
        raise ValueError(f"chunk ids occur more than once, e.g. {[r.chunk_id for r in repeated]}")


def read_store(spark: SparkSession, path: str, schema: T.StructType = STORE_SCHEMA) -> DataFrame:
    """Open a store, or a folder of chunks by category, with its schema spelled out, so that no
    partition value is guessed."""
    told = latest(spark, path)
    if told is None:
        return _opened(spark, path, schema)
    stored = None
    for number, part in enumerate(told["parts"]):
        rows = _opened(spark, f"{path}/{part}", schema)
        # Ids of chunks that went after this part was written.
        lists = [f"{path}/{gone}" for before, gone in told["gone"] if before > number]
        if lists:
            rows = rows.join(small_side(spark.read.schema("chunk_id string").parquet(*lists)), "chunk_id", "left_anti")
        rows = rows.select(*schema.fieldNames())
        stored = rows if stored is None else stored.unionByName(rows)
    return stored


def _opened(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = spark.read.schema(schema).parquet(path)
    return stored.withColumn(
        CATEGORY, F.when(F.col(CATEGORY) == _EMPTY_CATEGORY, F.lit("")).otherwise(F.col(CATEGORY))
    ).select(*schema.fieldNames())


def read_prebuilt(spark: SparkSession, path: str, schema: T.StructType = STORE_SCHEMA) -> DataFrame:
    """Open chunks and vectors prepared elsewhere, after checking the columns they bring."""
    found = spark.read.parquet(path)
    types = {f.name: f.dataType for f in found.schema}
    missing = [f.name for f in schema if f.name not in types]
    wrong = [
        f.name
        for f in schema
        if f.name in types and types[f.name].simpleString() != f.dataType.simpleString()
    ]
    if missing or wrong:
        raise ValueError(f"not a chunk table: missing columns {missing}, wrong types {wrong}")
    return found.select(*schema.fieldNames())


def join_vectors(
    chunks: DataFrame, vectors: DataFrame, chunk_id: str = "chunk_id", vector_id: str = "chunk_id"
) -> DataFrame:
    """Chunks with vectors from a table of their own, matched by id.

    Ids that occur more than once on either side would multiply and are an error.
    """
    _unique(chunks.select(F.col(chunk_id).alias("chunk_id")))
    named = vectors.select(F.col(vector_id).alias(chunk_id), "embedding")
    _unique(named.select(F.col(chunk_id).alias("chunk_id")))
    return chunks.join(named, chunk_id)


def check_dimension(store: DataFrame, dim: int) -> DataFrame:
    """Vectors whose length is not ``dim``, counted by length; empty for a fitting store."""
    return (
        store.groupBy(F.size("embedding").alias("dim"))
        .agg(F.count("*").alias("rows"))
        .where(F.col("dim") != dim)
    )


def write_cells(store: DataFrame, centres: np.ndarray, path: str) -> None:
    """Write a store as an index: its chunks by cell, and the centres beside them.

    Chunks are rebalanced by cell and a salt, so a full cell is written by many tasks and
    a small one by one.
    """
    spark = store.sparkSession
    salt = F.pmod(F.xxhash64("chunk_id"), F.lit(_SALTS))
    celled = assign_cells(store, centres).withColumn("_salt", salt).hint("rebalance", "cell", "_salt")
    celled.drop("_salt").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/chunks")
    rows = [(i, c) for i, c in enumerate(np.asarray(centres, float).tolist())]
    table = spark.createDataFrame(rows, "cell int, centre array<double>")
    table.write.mode("overwrite").parquet(f"{path}/centres")


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """The chunks of an index, with their cells, and its centres."""
    centres = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    return spark.read.parquet(f"{path}/chunks"), np.array([row.centre for row in centres])
