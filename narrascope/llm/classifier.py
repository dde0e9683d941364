"""Quality classifier: a factorisation machine over hashed words, text counts and metadata.

A document is a sparse vector: its words hashed into buckets, logarithmic counts scaled to
unit length, then a few ratios of its structure and given numeric columns, standardised. The
machine adds to a linear score the interactions of all pairs through vectors of low rank; by
the identity sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)
a score costs time linear in the words.

Vectors are made and scored by tasks over all documents. The machine is fitted on the driver
with at most ``most_rows`` labelled rows (those with the smallest hash of their id), a
documented bound whatever the corpus.

Defined results: null and empty texts have no words and are scored from what is left; null
metadata counts as 0; a label that is null is not used, of several labels of an id the
largest counts; without usable labels every score is 0.5; every row is scored, also with a
null or repeated id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrascope.llm.common import col, in_slices, keyed, lists_of, texts_of
from narrascope.llm.text_stats import text_stats

BUCKETS = 1 << 13
RANK = 8
MOST_ROWS = 12_000
_RATIOS = 12
_REMEMBERED = 1 << 18


class _Hashed(dict):
    """Bucket of each word met so far, A-Z lower-cased; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        bucket = self[word] = zlib.crc32(word.lower()) % BUCKETS
        return bucket


def _ratios(s) -> list[float]:
    words, lines, letters = max(1, s.n_words), max(1, s.n_lines), max(1, s.n_letters)
    return [
        np.log1p(s.n_words), s.word_chars / words, s.n_symbols / words, s.n_dup_lines / lines,
        s.n_repeat_words / words, np.log1p(s.n_words / lines), s.n_ended_lines / lines,
        s.n_distinct / words, s.n_top_word / words, s.n_upper / letters, s.n_marks / words,
        s.n_unlike_words / words,
    ]


def vector(text: str, hashed: dict) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets, their values, and the ratios of a text."""
    stats, numbers, ids = text_stats(text)
    buckets = np.fromiter(map(hashed.__getitem__, numbers), np.int64, len(numbers))
    counts = np.bincount(buckets, weights=np.bincount(ids, minlength=len(numbers)), minlength=1)
    used = np.flatnonzero(counts)
    values = np.log1p(counts[used])
    return used.astype(np.int32), (values / max(1e-9, np.linalg.norm(values))).astype(np.float32), _ratios(stats)


_VECTOR = "row long, buckets array<int>, weights array<float>, dense array<float>"


def _vectors(dense_at: int):
    def make():
        hashed = _Hashed()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [vector(text, hashed) for text in texts_of(batch.column(1))]
            sizes = [f[0].size for f in found]
            extra = np.array(batch.column(dense_at).to_pylist(), np.float64).reshape(len(found), -1)
            dense = np.concatenate([np.array([f[2] for f in found]).reshape(len(found), _RATIOS), extra], axis=1)
            flat = lambda i, kind: np.concatenate([np.empty(0, kind), *[f[i] for f in found]])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), lists_of(flat(0, np.int32), sizes, pa.int32()),
                 lists_of(flat(1, np.float32), sizes, pa.float32()),
                 lists_of(dense.ravel().astype(np.float32), [dense.shape[1]] * len(found), pa.float32())],
                ["row", "buckets", "weights", "dense"],
            )

        return step

    return make


@dataclass
class FactorisationMachine:
    """bias + <linear, x> + pairwise interactions through ``factors`` (feature, rank)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def sparse(self, buckets, weights, dense, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows as (feature, value, row), dense features behind the buckets."""
        rows, width = dense.shape
        dense = np.clip((dense - self.mean) / self.scale, -5, 5) / np.sqrt(max(1, width))
        features = np.r_[buckets, np.tile(np.arange(width) + BUCKETS, rows)]
        values = np.r_[weights, dense.ravel()]
        return features, values, np.r_[np.repeat(np.arange(rows), sizes), np.repeat(np.arange(rows), width)]

    def margins(self, features, values, rows, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and sum v_if x_i of each row."""
        parts = self.factors[features] * values[:, None]
        sums = np.stack([np.bincount(rows, parts[:, f], count) for f in range(parts.shape[1])], axis=1)
        squares = np.bincount(rows, (parts**2).sum(axis=1), count)
        linear = np.bincount(rows, self.linear[features] * values, count)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def scores(self, buckets, weights, dense, sizes) -> np.ndarray:
        if not len(dense):
            return np.empty(0)
        margins, _ = self.margins(*self.sparse(buckets, weights, dense, sizes), len(dense))
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def fit(buckets, weights, dense, sizes, labels, rank: int = RANK, epochs: int = 12, seed: int = 11) -> FactorisationMachine:
    """Fit by AdaGrad on small batches of logistic loss with weight decay."""
    rng = np.random.default_rng(seed)
    width = dense.shape[1]
    share = float(np.clip(labels.mean() if labels.size else 0.5, 0.01, 0.99))
    one_sided = not labels.size or labels.min() == labels.max()
    machine = FactorisationMachine(
        0.0 if not labels.size else float(np.log(share / (1 - share))), np.zeros(BUCKETS + width),
        np.zeros((BUCKETS + width, rank)) if one_sided else rng.normal(0, 0.05, (BUCKETS + width, rank)),
        dense.mean(axis=0) if labels.size else np.zeros(width),
        np.maximum(dense.std(axis=0), 1e-6) if labels.size else np.ones(width),
    )
    if one_sided:
        return machine
    starts = np.r_[0, np.cumsum(sizes)]
    seen_linear, seen_factors = np.full(BUCKETS + width, 1e-2), np.full((BUCKETS + width, rank), 1e-2)
    rate, decay, seen_bias = 0.15, 1e-4, 1e-2
    for _ in range(epochs):
        order = rng.permutation(labels.size)
        for at in range(0, labels.size, 128):
            batch = order[at : at + 128]
            taken = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in batch])
            features, values, rows = machine.sparse(buckets[taken], weights[taken], dense[batch], sizes[batch])
            margins, sums = machine.margins(features, values, rows, batch.size)
            error = (1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels[batch]) / batch.size
            pull = error[rows] * values
            used, which = np.unique(features, return_inverse=True)
            linear = np.bincount(which, pull) + decay * machine.linear[used]
            inner = pull[:, None] * (sums[rows] - machine.factors[features] * values[:, None])
            factors = np.stack([np.bincount(which, inner[:, f]) for f in range(rank)], axis=1)
            factors += decay * machine.factors[used]
            seen_linear[used] += linear**2
            seen_factors[used] += factors**2
            seen_bias += error.sum() ** 2
            machine.linear[used] -= rate * linear / np.sqrt(seen_linear[used])
            machine.factors[used] -= rate * factors / np.sqrt(seen_factors[used])
            machine.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return machine


def _prepared(docs: DataFrame, row: str, text_col: str, metadata: list[str]) -> DataFrame:
    extra = [F.signum(v) * F.log1p(F.abs(v)) for v in (F.coalesce(col(m).cast("double"), F.lit(0.0)) for m in metadata)]
    return docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"),
                       F.array(*extra).cast("array<double>").alias("extra"))


def train_classifier(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", metadata: tuple[str, ...] = ("n_chars",),
    usable: Column | None = None, most_rows: int = MOST_ROWS,
) -> FactorisationMachine:
    """Fit on labelled rows for which ``usable``, an expression over the id, holds."""
    docs, row = keyed(docs, id_col)
    marked = labels if usable is None else labels.filter(usable)
    marked = marked.select(col(id_col).alias("doc"), col(label_col).alias("label"))
    marked = marked.filter("doc IS NOT NULL AND label IS NOT NULL")
    marked = marked.groupBy("doc").agg(F.max("label").cast("double").alias("label"))
    ids = docs.select(col(id_col).alias("doc"), col(row).cast("long").alias("row"))
    chosen = ids.join(marked, "doc").orderBy(F.xxhash64("doc"), "row").limit(most_rows).select("row", "label").toArrow()
    chosen = F.broadcast(docs.sparkSession.createDataFrame(chosen, "row long, label double"))  # most_rows rows
    texts = _prepared(docs, row, text_col, list(metadata)).join(chosen, "row")
    vectors = in_slices(texts.select("row", "text", "extra"), _vectors(2), _VECTOR, 1)
    found = vectors.join(chosen, "row").orderBy("row").toArrow()
    sizes = found["buckets"].combine_chunks().value_lengths().to_numpy()
    flat = lambda name: found[name].combine_chunks().flatten().to_numpy()
    dense = flat("dense").reshape(found.num_rows, _RATIOS + len(metadata)).astype(np.float64)
    return fit(flat("buckets"), flat("weights"), dense, sizes, found["label"].to_numpy())


def score_documents(
    docs: DataFrame, machine: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text",
    metadata: tuple[str, ...] = ("n_chars",),
) -> DataFrame:
    """One row per document: row_key (its id where ids are unique), score from 0 to 1."""
    docs, row = keyed(docs, id_col)

    def make():
        vectors = _vectors(2)()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = vectors(batch)
            dense = found.column(3).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            scores = machine.scores(found.column(1).flatten().to_numpy(), found.column(2).flatten().to_numpy(),
                                    dense, found.column(1).value_lengths().to_numpy())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row_key", "score"])

        return step

    return in_slices(_prepared(docs, row, text_col, list(metadata)), make, "row_key long, score double", 1)
