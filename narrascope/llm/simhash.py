"""SimHash near-dedup by multi-index hashing.

A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints that differ in
at most three bits one segment differs in at most one, and there the smaller value turns
into the larger by setting one bit. So each distinct fingerprint is filed under its own
segment values and under all values that setting one zero bit gives, the upward half of its
Hamming ball. Where two meet, the whole distance is verified.

Meetings come out of one sort by segment value. Small groups are compared pair by pair; of
larger ones only a spanning forest is given, found by searches that take every member once.
A group beyond a size is filed again under four parts of the bits that are left, of which two
members that are linked have one in common, and so on, so no task holds a large one whole.

Defined results: a null or blank text has fingerprint zero, linked like any other; texts of
one or two words have one shingle, the whole sequence; equal texts, repeated rows and rows
with null ids are each a row of the result; an empty table gives an empty result; columns
other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, in_batches, in_slices, keep_rows, keyed, texts_of, word_blocks
from narrascope.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 3
_BLOCK_BYTES = 1 << 18
_PAIRWISE = 8
_LARGEST_GROUP = 1 << 16
#: Three bits that differ leave one of so many parts alone.
_PARTS = MOST_BITS + 1
#: The bits of the other segment, where the key is that of the lower and of the upper one.
_OTHER = np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF)


def _bit_counts(words: list[bytes], width: int) -> np.ndarray:
    """Of each bit, in how many hashes of ``width`` adjacent words it is set."""
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    digest, pairs = xxhash.xxh64_intdigest, zip([0, *ends], ends[width - 1 :])
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in pairs], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str) -> int:
    """Bits set in more than half of the hashes of all word shingles, as a number below 2^64."""
    total, shingles, words = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.encode().lower(), SHINGLE_WORDS - 1, _BLOCK_BYTES):
        if len(words) >= SHINGLE_WORDS:
            total += _bit_counts(words, SHINGLE_WORDS)
            shingles += len(words) - SHINGLE_WORDS + 1
    if not shingles and words:
        total, shingles = _bit_counts(words, len(words)), 1
    return int(np.packbits(2 * total > shingles, bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    values = np.array([fingerprint(t) for t in texts_of(batch.column(2))], np.uint64)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["row", "doc", "fp"]
    )


def _filed(batch: pa.RecordBatch) -> pa.Table:
    """Each fingerprint under its segment values and those one set bit above."""
    fps = batch.column(0).to_numpy()
    halves = fps.view(np.uint64)
    keys, members = [], []
    for segment in (0, 1):
        value = (halves >> np.uint64(32 * segment)) & np.uint64(0xFFFFFFFF)
        for bit in [None, *range(32)]:
            above, who = value, fps
            if bit is not None:
                zero = (value >> np.uint64(bit)) & np.uint64(1) == 0
                above, who = value[zero] | np.uint64(1 << bit), fps[zero]
            keys.append((above | np.uint64(segment << 32)).view(np.int64))
            members.append(who)
    return pa.table({"key": np.concatenate(keys), "fp": np.concatenate(members)})


def _spanning(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected: each member is reached once."""
    left = fps
    while left.size > 1:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= MOST_BITS
            if near.any():
                found, left = left[near], left[~near]
                yield np.full(found.size, at), found
                queue.extend(found)


def _links_of(keys: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among whole groups of equal keys, which lie together."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, keys.size])
    small = np.repeat(sizes <= _PAIRWISE, sizes)
    for lag in range(1, _PAIRWISE):
        a, b = fps[:-lag], fps[lag:]
        near = (keys[:-lag] == keys[lag:]) & small[lag:] & (np.bitwise_count(a ^ b) <= MOST_BITS)
        if near.any():
            yield a[near], b[near]
    for at in np.flatnonzero(sizes > _PAIRWISE):
        yield from _spanning(fps[starts[at] : starts[at] + sizes[at]])


def _meetings(largest: int):
    """Links (a, b) of rows (key, fp, left) sorted by key; members of too large groups with
    null for b. ``left`` marks the bits that the members of a group may differ in."""

    def batch_of(key, a, b, left) -> pa.RecordBatch:
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(a.view(np.int64)), b, pa.array(left.view(np.int64))], ["key", "a", "b", "left"]
        )

    def linked(keys, fps):
        found = list(_links_of(keys, fps))
        if found:
            a, b = (np.concatenate(side) for side in zip(*found))
            yield batch_of(np.zeros(a.size, np.int64), a, b, np.zeros(a.size, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, rest, overflown = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), None
        for batch in batches:
            new = batch.column(0).to_numpy()
            left = batch.column(2).to_numpy().view(np.uint64) if batch.num_columns > 2 else np.where(new < 1 << 32, *_OTHER)
            keys, rest = np.concatenate([keys, new]), np.concatenate([rest, left])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if overflown is not None:
                same = int(np.searchsorted(keys, overflown, "right"))
                yield batch_of(keys[:same], fps[:same], None, rest[:same])
                keys, fps, rest = keys[same:], fps[same:], rest[same:]
            if not keys.size:
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from linked(keys[:last], fps[:last])
                keys, fps, rest = keys[last:], fps[last:], rest[last:]
            overflown = None
            if keys.size > largest and np.bitwise_count(rest[0]) >= _PARTS:
                overflown = keys[-1]
                yield batch_of(keys, fps, None, rest)
                keys, fps, rest = keys[:0], fps[:0], rest[:0]
        if keys.size:
            yield from linked(keys, fps)

    return run


def _parts_of(left: int) -> list[int]:
    """The bits of a mask in four masks of nearly equal size."""
    bits = [1 << i for i in range(64) if left >> i & 1]
    return [sum(bits[i * len(bits) // _PARTS : (i + 1) * len(bits) // _PARTS]) for i in range(_PARTS)]


def _filed_again(batch: pa.RecordBatch) -> pa.Table:
    """Members of large groups (key, fp, left) under each part of the bits that are left."""
    key, fps, left = (batch.column(c).to_numpy() for c in range(3))
    out = []
    for mask in np.unique(left):
        these = left == mask
        for number, part in enumerate(_parts_of(int(mask.astype(np.uint64)))):
            value = fps[these].view(np.uint64) & np.uint64(part)
            told = np.stack([key[these].view(np.uint64), value, np.full(value.size, number, np.uint64)], axis=1)
            keys = [xxhash.xxh64_intdigest(row) for row in told.astype("<u8").reshape(-1).view("V24").tolist()]
            rest = np.full(value.size, mask.astype(np.uint64) & ~np.uint64(part), np.uint64)
            out.append((np.array(keys, np.uint64).view(np.int64), fps[these], rest.view(np.int64)))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
    return pa.table(columns, ["key", "fp", "left"])


def _meet(filed: DataFrame, largest: int) -> DataFrame:
    by_key = filed.repartition("key").sortWithinPartitions("key")
    return pinned(by_key.mapInArrow(_meetings(largest), "key long, a long, b long, left long"), "meetings")


def near_links(fps: DataFrame, largest_group: int = _LARGEST_GROUP) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) differing in at most 3 bits."""
    filed, links = in_batches(fps.select("fp"), _filed, "key long, fp long"), None
    while filed is not None:
        met = _meet(filed, largest_group)
        found = met.filter("b IS NOT NULL").select("a", "b")
        links = found if links is None else links.unionByName(found)
        large = met.filter("b IS NULL").select("key", F.col("a").alias("fp"), "left")
        filed = in_batches(large, _filed_again, "key long, fp long, left long") if large.head(1) else None
    return links.distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row_key, id, fp (signed), component_id, kept.

    ``component_id`` is the smallest id that links reach (null ids last) and ``kept`` marks
    its row, one of each component.
    """
    docs, row = keyed(docs, id_col)
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(col(row).cast("long").alias("row"), col(id_col).alias("doc"), col(text_col).alias("text"))
    marked = pinned(in_slices(texts, lambda: _fingerprints, f"row long, doc {kind}, fp long", 2), "fingerprints")
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    distinct = pinned(marked.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = components(near_links(distinct)).withColumnRenamed("vertex", "fp")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = placed.groupBy("root").agg(F.min("first").alias("least"))
    labels = placed.join(firsts, "root").select("fp", "least")
    return marked.join(labels, "fp").select(
        F.col("row").alias("row_key"),
        F.col("doc").alias("id"),
        "fp",
        F.col("least.doc").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, columns as they are."""
    columns = docs.columns
    rows, row = keyed(docs, id_col)
    kept = simhash_groups(rows, row, text_col).filter("kept").select("row_key")
    return keep_rows(rows, row, kept, columns)
