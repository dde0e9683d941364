"""Token counts of texts of any length, huge ones spliced from overlapping chunks.

A huge document is cut into chunks that overlap, so that its chunks are encoded in different
tasks. Each chunk reports, for the places in its overlaps where a token begins behind a
stable boundary, how many of its tokens lie before. A boundary is stable where white space
follows a character that is none, far enough from the chunk's ends for any special string:
no word, sign run or special string of the tokenizer goes across, whatever lies around it.
Two neighbours that both begin a token there agree from there on, and their counts are
spliced at it. A document of which two neighbours share no such place is done again with
chunks and overlaps twice as wide, in the end as one chunk.

Defined results: null counts as empty, which has no tokens; every row is counted, also with
a null or repeated id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, in_slices, keyed, texts_of
from narrascope.llm.tokens import _EDGE, text_encoder

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10


def _whole_counts(path: str):
    def make():
        encoder = text_encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            _, counts = encoder.encode(batch.column(1))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["row", "n_tokens"])

        return step

    return make


def _cut(chunk: int, overlap: int):
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, numbers, starts, lasts, parts = [], [], [], [], []
            for row, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                for number, start in enumerate(range(0, max(1, len(text) - overlap), chunk)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    parts.append(text[start : start + chunk + overlap])
                    lasts.append(start + chunk + overlap >= len(text))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(numbers, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(lasts, pa.bool_()), pa.array(parts, pa.string())],
                ["row", "number", "start", "last", "part"],
            )

        return step

    return make


def _places(path: str, overlap: int):
    """Of each chunk, rows (row, joint, side, place, before); the last chunk's total has place -1.

    Joint i lies between chunks i - 1 and i. Side 1 is the chunk before it, -1 the one behind.
    """

    def make():
        tokenizer = text_encoder(path).tokenizer
        margin = max([1, *(len(t.content) for t in tokenizer.get_added_tokens_decoder().values())])

        def one(row, number, start, last, part):
            offsets = tokenizer.encode(part, add_special_tokens=False).offsets
            begins = np.fromiter((a for a, _ in offsets), np.int64, len(offsets))
            if last:
                yield row, number, 0, -1, len(offsets)
            zones = [] if number == 0 else [(number, -1, margin, overlap - margin)]
            if not last:
                zones.append((number + 1, 1, len(part) - overlap + margin, len(part) - margin))
            for joint, side, low, high in zones:
                for edge in _EDGE.finditer(part, max(0, low - 1), max(0, high)):
                    before = int(np.searchsorted(begins, edge.end()))
                    if before < begins.size and begins[before] == edge.end():
                        yield row, joint, side, start + edge.end(), before

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [p for chunk in zip(*(c.to_pylist() for c in batch.columns)) for p in one(*chunk)]
            columns = list(zip(*found)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["row", "joint", "side", "place", "before"]
            )

        return step

    return make


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens); null where two neighbours share no stable boundary."""
    chunks = in_slices(huge, _cut(chunk, overlap), "row long, number long, start long, last boolean, part string", 1)
    chunks = chunks.repartition("row", "number")
    places = pinned(
        in_slices(chunks, _places(path, overlap), "row long, joint long, side long, place long, before long", 4),
        "places",
    )
    left = places.filter("side = 1").select("row", "joint", "place", F.col("before").alias("left"))
    right = places.filter("side = -1").select("row", "joint", "place", F.col("before").alias("right"))
    shared = left.join(right, ["row", "joint", "place"])
    joints = shared.groupBy("row", "joint").agg(F.max_by(F.col("left") - F.col("right"), "place").alias("more"))
    joints = joints.groupBy("row").agg(F.count("*").alias("joined"), F.sum("more").alias("more"))
    # The total's joint is the number of the last chunk, so the number of joints.
    ends = places.filter("place = -1").select("row", F.col("joint").alias("joints"), F.col("before").alias("end"))
    whole = F.coalesce("joined", F.lit(0)) == F.col("joints")
    return ends.join(joints, "row", "left").select(
        "row", F.when(whole, F.col("end") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    )


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per document: row_key (its id where ids are unique), n_bytes, n_tokens.

    ``tokenizer`` is the path of a tokenizers file on every executor. Texts longer than
    ``chunk`` and ``overlap`` together are spliced if the tokenizer is a byte-level BPE;
    other tokenizers encode every text whole.
    """
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    size, long = F.coalesce(F.length("text"), F.lit(0)), chunk + overlap
    if not text_encoder(tokenizer).cuttable:
        long = (1 << 31) - 1
    counted = in_slices(texts.filter(size <= long), _whole_counts(tokenizer), "row long, n_tokens long", 1)
    huge = texts.filter(size > long)
    while True:
        found = pinned(_spliced(huge, tokenizer, chunk, overlap), "spliced")
        counted = counted.unionByName(found.filter("n_tokens IS NOT NULL"))
        left = found.filter("n_tokens IS NULL").select("row")
        if not left.head(1):
            break
        chunk, overlap = 2 * chunk, 2 * overlap
        huge = huge.join(left, "row", "left_semi")
    bytes_of = texts.select("row", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return counted.join(bytes_of, "row").select(F.col("row").alias("row_key"), "n_bytes", "n_tokens")
