"""Token ids as ORC files in document order.

Rows are pieces of documents in ascending document order: the id columns and the ids are
whole-number columns, which ORC writes run-length encoded, in stripes with row indexes and
Bloom filters on the document id. Stripes are read in parallel, and a look-up of some
documents skips files, stripes and row groups by their statistics and filters. A piece holds
a bounded number of ids, so no row grows with a document.

Slices of the files follow each other in document order. Where a document starts is the sum
of whole slices before its own, of which there are as many as shuffle partitions, and of the
documents before it in its slice.

Defined results: a null or empty text is its end token alone; rows with null ids come first,
rows with equal ids follow each other in any order; an empty table gives files without rows;
columns other than id and text are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrascope.llm.common import col, in_batches, in_slices, keyed, lists_of
from narrascope.llm.tokens import text_encoder

END_ID = 2
PIECE_IDS = 1 << 16
#: How the files are written; a row group is what an index entry covers.
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}
#: The CRC-32 polynomial, bits reversed; a fixed value of the checksum.
_POLYNOMIAL = 0xEDB88320


def _encoded(path: str, end_id: int, piece_ids: int):
    def make():
        encoder = text_encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            places, numbers, parts = [], [], []
            ids_of_all, counts = encoder.encode(batch.column(2))
            edges = np.r_[0, np.cumsum(counts)].tolist()
            for place, (a, b) in enumerate(zip(edges, edges[1:])):
                ids = np.append(ids_of_all[a:b], np.uint32(end_id))
                for number, at in enumerate(range(0, ids.size, piece_ids)):
                    places.append(place)
                    numbers.append(number)
                    parts.append(ids[at : at + piece_ids])
            flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
            sizes = [p.size for p in parts]
            taken = pa.array(places, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(numbers, pa.int32()),
                 pa.array(sizes, pa.int32()), lists_of(flat, sizes, pa.int32())],
                ["row_key", "doc_id", "piece", "n_ids", "ids"],
            )

        return step

    return make


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, piece_ids: int = PIECE_IDS,
) -> None:
    """Write the ids of all texts, ``end_id`` after each, to ORC files under ``path``."""
    docs, row = keyed(docs, id_col)
    kind = dict(docs.dtypes)[id_col]
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(col(row).cast("long").alias("row"), col(id_col).alias("doc"), col(text_col).alias("text"))
    texts = texts.repartitionByRange(slices, "row").sortWithinPartitions("row")
    schema = f"row_key long, doc_id {kind}, piece int, n_ids int, ids array<int>"
    rows = in_slices(texts, _encoded(tokenizer, end_id, piece_ids), schema, 2)
    rows = rows.withColumn("slice", F.spark_partition_id())
    rows.write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """Pieces (row_key, doc_id, piece, n_ids, ids, slice), of all documents or of some.

    A filter on ``doc_ids`` reaches the files' indexes and Bloom filters.
    """
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's, bits reversed."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
        bit >>= 1
    return out


def joined_crc(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings in a row from that of each and the second's length."""
    shift, power, bits = 1 << 31, 1 << 30, 8 * length
    while bits:
        if bits & 1:
            shift = _times(shift, power)
        power = _times(power, power)
        bits >>= 1
    return _times(shift, first) ^ second


def _piece_sums(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column(5)
    flat = ids.flatten().to_numpy().astype("<u4")
    edges = np.r_[0, np.cumsum(ids.value_lengths().to_numpy())].tolist()
    sums = [zlib.crc32(flat[a:b]) for a, b in zip(edges, edges[1:])]
    return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sums, pa.int64())],
                                      ["slice", "row_key", "doc_id", "piece", "n_ids", "crc"])


def _document_sums(batch: pa.RecordBatch) -> pa.RecordBatch:
    sums = []
    for pieces in batch.column(4).to_pylist():
        total = pieces[0]["crc"]
        for piece in pieces[1:]:
            total = joined_crc(total, piece["crc"], 4 * piece["n_ids"])
        sums.append(total)
    return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())],
                                      ["slice", "row_key", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(row_key, doc_id, start, n_tokens, ids_crc32) of each document, read from its files."""
    rows = read_token_files(spark, path)
    kind = dict(rows.dtypes)["doc_id"]
    head = f"slice int, row_key long, doc_id {kind}"
    sums = in_batches(rows.select("slice", "row_key", "doc_id", "piece", "n_ids", "ids"), _piece_sums,
                      f"{head}, piece int, n_ids int, crc long")
    pieces = sums.groupBy("slice", "row_key", "doc_id").agg(
        F.sum("n_ids").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("piece", "n_ids", "crc"))).alias("pieces")
    )
    documents = in_batches(pieces, _document_sums, f"{head}, n_tokens long, ids_crc32 long")

    # As many rows as there are slices, so as shuffle partitions.
    totals = sorted(rows.groupBy("slice").agg(F.sum("n_ids")).collect())
    before = [(s, int(b)) for (s, _), b in zip(totals, np.cumsum([0, *(n for _, n in totals)]))]
    before = F.broadcast(spark.createDataFrame(before, "slice int, before long"))
    inside = Window.partitionBy("slice").orderBy("row_key")
    start = F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens")
    return documents.join(before, "slice").select("row_key", "doc_id", start.alias("start"), "n_tokens", "ids_crc32")
