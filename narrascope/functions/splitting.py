"""Cutting text into overlapping chunks.

``split_fixed`` cuts at character positions and is a plain Spark expression.
``split_recursive`` prefers paragraph, line, sentence and word borders. It has no
built-in counterpart, so it runs as an Arrow UDF: only the text column goes to Python,
and a text costs one search per separator plus one binary search per chunk.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.functions.text import strip
from narrascope.schema import CHUNK_OVERLAP, CHUNK_SEPARATORS, CHUNK_SIZE

_TEXTS_BYTES = 1 << 20


def _check(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError("the overlap must not be negative and must be below the chunk size")


def split_fixed(c: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of ``size``-character windows, each starting ``size - overlap`` after the last.

    The lookahead captures a window while the match itself moves on by one step, so the
    text is read once however long it is. No last window lies inside the overlap of the
    one before it.
    """
    _check(size, overlap)
    step = size - overlap
    windows = F.regexp_extract_all(
        c, F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"), F.lit(1)
    )
    wanted = F.greatest(F.ceil((F.length(c) - overlap) / step), F.lit(1)).cast("int")
    stripped = F.transform(F.slice(windows, F.lit(1), wanted), strip)
    return F.filter(stripped, lambda w: w != "")


def _cuts(text: str, start: int, end: int, separators: Sequence[str], size: int):
    """Runs of cut offsets; the pieces of one run may be merged with each other."""
    rest = list(separators)
    while rest and rest[0] and text.find(rest[0], start, end) < 0:
        rest.pop(0)
    if not rest:
        yield [start, end]
        return
    separator = rest.pop(0)
    if not separator:
        yield range(start, end + 1)
        return
    offsets = [start]
    at = text.find(separator, start, end)
    while at >= 0:
        if at > start:
            offsets.append(at)
        at = text.find(separator, at + len(separator), end)
    offsets.append(end)
    run = [start]
    for left, right in pairwise(offsets):
        if right - left < size:
            run.append(right)
            continue
        if len(run) > 1:
            yield run
        yield from _cuts(text, left, right, rest, size)
        run = [right]
    if len(run) > 1:
        yield run


def _spans(run: Sequence[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Longest spans of whole pieces within ``size``, overlapping by at most ``overlap``."""
    first, last = 0, len(run) - 1
    while True:
        stop = max(bisect_right(run, run[first] + size) - 1, first + 1)
        yield run[first], run[stop]
        if stop >= last:
            return
        first = bisect_left(run, max(run[stop] - overlap, run[stop + 1] - size), first + 1, stop)


def split_text(
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = tuple(CHUNK_SEPARATORS),
) -> list[str]:
    """Chunks of one text, in order, stripped and never empty."""
    if not text:
        return []
    pieces = (
        text[a:b].strip()
        for run in _cuts(text, 0, len(text), separators, size)
        for a, b in _spans(run, size, overlap)
    )
    return [p for p in pieces if p]


def _few_texts(texts: pa.Array, most: int = _TEXTS_BYTES) -> Iterator[pa.Array]:
    """Texts in runs of about ``most`` bytes, or one text where it has more."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(texts)].tolist()
    return (texts.slice(a, b - a) for a, b in pairwise(edges) if b > a)


def split_recursive(
    c: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = tuple(CHUNK_SEPARATORS),
) -> Column:
    """Array of chunks cut at the coarsest separator that keeps them within ``size``."""
    _check(size, overlap)
    separators = tuple(separators)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        # Python strings of a few texts at a time; what is cut is held by Arrow.
        parts = [
            pa.array(
                [None if t is None else split_text(t, size, overlap, separators) for t in part.to_pylist()],
                kind,
            )
            for part in _few_texts(texts)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return split(c)
