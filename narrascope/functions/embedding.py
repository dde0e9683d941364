"""Turning text into unit vectors through a caller's model.

A model is given as a factory: ``factory()`` runs once per task, on the executor, and
returns ``encode(list[str]) -> array of shape (n, dim)``. Weights are therefore never
pickled with the plan and heavy imports stay inside the factory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import md5
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.schema import EMBED_BATCH, EMBEDDING_DIM

Encoder = Callable[[list[str]], np.ndarray]

_REMEMBERED_WORDS = 1 << 18
_WORD = re.compile("[a-z0-9]+")


class _Buckets(dict):
    """Bucket of each word met so far, emptied when it has grown large."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED_WORDS:
            self.clear()
        bucket = int(md5(word.encode()).hexdigest()[:8], 16) % self.dim
        self[word] = bucket
        return bucket


def _encode_words(texts: list[str], buckets: _Buckets) -> np.ndarray:
    dim = buckets.dim
    words = [_WORD.findall(text.lower()) for text in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    found = map(buckets.__getitem__, chain.from_iterable(words))
    cells = np.fromiter(found, np.int64, int(lengths.sum()))
    cells += np.repeat(np.arange(len(texts)) * dim, lengths)
    return np.bincount(cells, minlength=len(texts) * dim).reshape(len(texts), dim)


def hashed_words(dim: int = EMBEDDING_DIM) -> Encoder:
    """Stand-in encoder: word counts hashed into ``dim`` buckets, for use without a model."""
    return partial(_encode_words, buckets=_Buckets(dim))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero."""
    vectors = np.asarray(vectors, dtype=np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _rows_for(texts: list[str], encoder: Encoder) -> np.ndarray:
    rows = unit_rows(encoder(texts))
    if rows.ndim != 2 or len(rows) != len(texts):
        raise ValueError(f"the encoder gives {rows.shape} for {len(texts)} texts")
    return rows


def embed(
    c: Column,
    factory: Callable[[], Encoder] = hashed_words,
    batch_size: int = EMBED_BATCH,
) -> Column:
    """Unit vector of each text as ``array<float>``; null text gives a null vector.

    Only the text goes to Python. Vectors come back as one flat Arrow buffer per batch.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for batch in batches:
            known = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
            # Texts and double precision of one call at a time; the batch is held as it is returned.
            parts = [
                _rows_for(batch.take(pa.array(known[i : i + batch_size])).to_pylist(), encoder).astype(np.float32)
                for i in range(0, len(known), batch_size)
            ]
            if len({part.shape[1] for part in parts}) > 1:
                raise ValueError("the encoder gives vectors of different lengths")
            lengths = np.zeros(len(batch), np.int64)
            lengths[known] = parts[0].shape[1] if parts else 0
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
            del parts
            yield pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(flat.ravel()), mask=pc.is_null(batch)
            )

    return encode(c)
