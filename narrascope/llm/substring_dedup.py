"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text, and a chunk ends where its top bits are zero.
The hash looks back sixteen bytes, so inside a repeated passage all texts are cut alike,
whatever stands before it. Chunks are compared by digest; the first place of a digest, by
document and offset, is its owner, and so is the place before it in the text itself, which
takes a phrase repeated many times for a passage that repeats itself. Adjacent chunks that go on
in one owner at one shift form a run. At either end the passage may reach into chunks that other
text has changed or that have another owner: the bytes there are compared with those beside the
owner's chunks, and the run is extended as far as they agree. Runs of one owner and shift that then touch are one. What
covers ``min_words`` whole words in one owner is cut out; only then are spans merged. Owners
come before what refers to them, so each passage is left in one place.

Chunks are counted before they are shuffled and joined to the repeated ones; a digest that
is everywhere is summed early, and its join can be split. Only the bytes beside owners are
looked up again.

Defined results: null texts stay null and have no spans; empty texts stay empty; repeats
inside one document are cut too, of one phrase repeated all but the first; every row is kept,
with an empty text if all of it repeats; rows with equal or null ids are documents of their own; an empty table gives an empty
result; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, in_slices, keyed, unused

MIN_WORDS = 50
MAX_CHUNK = 256
#: Longer chunks are cut further.
_WIDE_CHUNK = 128
_LOOK_BACK = 16
#: A chunk ends where these of the sixteen bits are zero, on average each 32 bytes.
_MASK = np.uint16(0xF800)
#: A passage of 50 words has whole chunks of so many bytes but for rare cases.
_MIN_RUN_BYTES = 48
#: So far bytes beside a run are compared, more than nearly all chunks have.
_REACH = 192
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_GEAR = np.array([xxhash.xxh64_intdigest(bytes([i]), 0x9EA2) & 0xFFFF for i in range(256)], np.uint16)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Sum of the gear values of the last sixteen bytes, each shifted by its distance."""
    out = _GEAR[data]
    span = 1
    while span < _LOOK_BACK:
        earlier = out[:-span] << np.uint16(span)
        out = out.copy()
        out[span:] += earlier
        span *= 2
    return out


def _least_places(hashes: np.ndarray, start: int, end: int) -> list[int]:
    """Ends inside a wide chunk where the hash of its own bytes is least, not too near, and so on
    in what is still wide between them."""
    found, left = [], [(start, end)]
    while left:
        start, end = left.pop()
        inside = hashes[start + _LOOK_BACK - 1 : end - 1]
        places = np.flatnonzero(inside == inside.min()) + start + _LOOK_BACK
        kept = [start]
        while (at := int(np.searchsorted(places, kept[-1] + _LOOK_BACK))) < places.size:
            kept.append(int(places[at]))
        found += kept[1:]
        left += [(a, b) for a, b in zip(kept, [*kept[1:], end]) if b - a > _WIDE_CHUNK]
    return found


def _cuts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of texts that lie one behind another."""
    hashes = _rolling(data)
    cut = (hashes & _MASK) == 0
    starts_of_texts = np.r_[0, ends[:-1]]
    # There the hash would look into the text before.
    for offset in range(_LOOK_BACK - 1):
        early = starts_of_texts + offset
        cut[early[early < data.size]] = False
    cut[ends[ends > 0] - 1] = True
    bounds = np.flatnonzero(cut) + 1
    starts = np.r_[0, bounds[:-1]]
    # Where no end is near, the places of the least hash are ends: a phrase repeated is cut into
    # equal chunks, and alike whatever stands before it.
    wide = np.flatnonzero(bounds - starts > _WIDE_CHUNK)
    least = [_least_places(hashes, a, b) for a, b in zip(starts[wide].tolist(), bounds[wide].tolist())]
    bounds = np.sort(np.concatenate([bounds, *[np.array(places, bounds.dtype) for places in least]]))
    starts = np.r_[0, bounds[:-1]]
    parts = -(-(bounds - starts) // MAX_CHUNK)
    which = np.repeat(np.arange(bounds.size), parts)
    inside = np.arange(which.size) - np.repeat(np.cumsum(parts) - parts, parts)
    first = starts[which] + inside * MAX_CHUNK
    return first, np.minimum(first + MAX_CHUNK, bounds[which])


def _chunks():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
        whole = b"".join(texts.to_pylist())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        if not whole:
            ends = np.empty(0, np.int64)
            first, last = ends, ends
        else:
            first, last = _cuts(np.frombuffer(whole, np.uint8), ends)
        digest = xxhash.xxh3_64_intdigest
        digests = np.array([digest(whole[a:b]) for a, b in zip(first.tolist(), last.tolist())], np.uint64).view(np.int64)
        text = np.searchsorted(ends, first, "right")
        rows = batch.column(0).to_numpy()[text]
        starts = first - np.r_[0, ends][text]
        # The place of the same digest before this one in its text, its own for the first.
        order = np.lexsort((first, digests, text))
        new = np.ones(order.size, bool)
        new[1:] = (digests[order][1:] != digests[order][:-1]) | (text[order][1:] != text[order][:-1])
        own = np.empty(order.size, np.int64)
        own[order] = starts[order][np.arange(order.size) - ~new]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(last - first, pa.int32()),
             pa.array(digests), pa.array(own, pa.int32())],
            ["row", "start", "size", "digest", "own_start"],
        )

    return step


_RUN = "row long, start int, end int, owner_row long, shift int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of adjacent chunks (row, start, size, owner_row, owner_start, own_start), sorted by
    place, that go on in one owner, or earlier in their own text, at one shift. They are left out
    where all adjacent chunks are too short."""
    last, since, runs, going = None, 0, [], {}
    for batch in batches:
        out = []
        for row, start, size, owner, at, own in zip(*(c.to_pylist() for c in batch.columns)):
            if last != (row, start):
                out += runs if last and last[1] - since >= _MIN_RUN_BYTES else []
                since, runs, going = start, [], {}
            elif len(runs) > 8 and start - since >= _MIN_RUN_BYTES:
                out += [run for run in runs if run[2] < start]
                runs = [run for run in runs if run[2] == start]
            before, going = going, {}
            keys = {(owner, start - at), (row, start - own)} - {(row, 0)}
            # Inside a longer run none begins: one that goes on behind it begins there, and the
            # bytes before are compared.
            covered = any(key in before and start - before[key][1] >= _WIDE_CHUNK for key in keys)
            for key in keys:
                run = before.get(key)
                if run is None:
                    if covered:
                        continue
                    run = [row, start, start, *key]
                    runs.append(run)
                run[2] = start + size
                going[key] = run
            last = row, start + size
        yield _run_batch(out)
    if last and last[1] - since >= _MIN_RUN_BYTES:
        yield _run_batch(runs)


def _run_batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    columns = list(zip(*rows)) or [[]] * 5
    names = [field.split()[0] for field in _RUN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _beside():
    """The bytes before (side 0) or behind (side 1) wanted places of a text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        texts = pc.fill_null(batch.column(1), "").cast(pa.binary())
        for row, text, places in zip(batch.column(0).to_pylist(), texts.to_pylist(), batch.column(2).to_pylist()):
            for place in places:
                at, side = place["at"], place["side"]
                found = text[at : at + _REACH] if side else text[max(0, at - _REACH) : at]
                out.append((row, at, side, found))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "at", "side", "beside"])

    return step


def _agree(a: bytes, b: bytes, from_end: bool) -> int:
    """Bytes on which two strings agree at their ends or at their starts."""
    size = min(len(a), len(b))
    if from_end:
        a, b = a[len(a) - size :][::-1], b[len(b) - size :][::-1]
    x, y = np.frombuffer(a[:size], np.uint8), np.frombuffer(b[:size], np.uint8)
    other = np.flatnonzero(x != y)
    return int(other[0]) if other.size else size


def passages(data: bytes, runs: list[dict], min_words: int) -> list[tuple[int, int]]:
    """Byte spans of whole words to cut out, merged and in order.

    Each is made of spans that alone cover ``min_words`` words of one owner, without a gap.
    """
    by_owner: dict[tuple[int, int], list[list[int]]] = {}
    for run in sorted(runs, key=lambda r: r["start"]):
        start, end = run["start"], run["end"]
        start -= _agree(data[max(0, start - _REACH) : start], run["before"] or b"", True)
        end += _agree(data[end : end + _REACH], run["behind"] or b"", False)
        spans = by_owner.setdefault((run["owner_row"], run["shift"]), [])
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    white = lambda i: i < 0 or i >= len(data) or data[i] in b" \t\n\x0b\x0c\r"
    out: list[tuple[int, int]] = []
    for start, end in sorted((a, b) for spans in by_owner.values() for a, b in spans):
        while start < end and not white(start) and not white(start - 1):
            start += 1
        while end > start and not white(end) and not white(end - 1):
            end -= 1
        if (not out or end > out[-1][1]) and len(data[start:end].split()) >= min_words:
            if out and start <= out[-1][1]:
                start = out.pop()[0]
            out.append((start, end))
    return out


def _cut_out(text_at: int, runs_at: int, min_words: int, names: list[str]):
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, spans = batch.column(text_at).to_pylist(), []
            for i, (text, runs) in enumerate(zip(texts, batch.column(runs_at).to_pylist())):
                found = []
                if runs:
                    data, at, kept, chars = text.encode(), 0, [], 0
                    for start, end in passages(data, runs, min_words):
                        kept.append(data[at:start])
                        chars += len(kept[-1].decode())
                        size = len(data[start:end].decode())
                        found.append({"start": chars, "end": chars + size})
                        at, chars = end, chars + size
                    texts[i] = (b"".join(kept) + data[at:]).decode()
                spans.append(found)
            columns = [*batch.columns]
            columns[text_at] = pa.array(texts, pa.string())
            columns[runs_at] = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            return pa.RecordBatch.from_arrays(columns, names)

        return step

    return make


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
) -> tuple[DataFrame, str]:
    """``docs`` without repeated passages of at least ``min_words`` words, and the name of a
    column added to them: the spans cut out, as (start, end) in characters of the text before.

    Of the places of a passage the one in the smallest id stays.
    """
    spans_col, columns = unused(docs, "cut_spans"), docs.columns
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    chunks = in_slices(texts, _chunks, "row long, start int, size int, digest long, own_start int", 1)
    owners = chunks.groupBy("digest", "size").agg(
        F.count("*").alias("places"),
        F.min("row").alias("owner_row"),
        F.expr("min_by(start, row) FILTER (WHERE own_start = start)").alias("owner_start"),
    ).filter("places > 1")
    repeats = chunks.join(owners, ["digest", "size"]).filter("row <> owner_row OR start <> owner_start")
    repeats = repeats.select("row", "start", "size", "owner_row", "owner_start", "own_start")
    runs = repeats.repartition("row").sortWithinPartitions("row", "start").mapInArrow(_runs, _RUN)
    runs = pinned(runs, "runs")

    places = [
        runs.select(F.col("owner_row").alias("row"), (F.col(edge) - F.col("shift")).alias("at"), F.lit(i).alias("side"))
        for i, edge in enumerate(("start", "end"))
    ]
    wanted = places[0].unionByName(places[1]).distinct()
    wanted = wanted.groupBy("row").agg(F.collect_list(F.struct("at", "side")).alias("places"))
    beside = in_slices(texts.join(wanted, "row").select("row", "text", "places"), _beside,
                       "row long, at int, side int, beside binary", 1)
    beside = pinned(beside, "beside")
    for i, (edge, name) in enumerate((("start", "before"), ("end", "behind"))):
        own = beside.filter(F.col("side") == i).select(
            F.col("row").alias("owner_row"), F.col("at").alias(f"{edge}_at"), F.col("beside").alias(name)
        )
        runs = runs.withColumn(f"{edge}_at", F.col(edge) - F.col("shift")).join(own, ["owner_row", f"{edge}_at"], "left")
    found = runs.groupBy(F.col("row").alias(row)).agg(
        F.collect_list(F.struct("start", "end", "owner_row", "shift", "before", "behind")).alias(spans_col)
    )
    joined = docs.join(found, row, "left").select(*[col(c) for c in columns], col(spans_col))
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField(spans_col, kind)])
    step = _cut_out(columns.index(text_col), len(columns), min_words, [*columns, spans_col])
    # Arrow steps look columns up by name and would take a dot in one for a field.
    plain = joined.toDF(*[f"c{i}" for i in range(len(joined.columns))])
    return in_slices(plain, step, schema, columns.index(text_col)), spans_col
