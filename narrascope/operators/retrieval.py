"""Top-k nearest chunks for a whole table of questions.

Distance is one minus cosine, rounded to six places so that the ranking does not depend
on the order of additions; equal distances are ranked by chunk id.

``nearest_chunks`` keeps a question table of checked size resident in every task and
scans the store once, where it lies. A task scores Arrow batches as matrix products, of
bytes where they can be had, and keeps k rows per question, so only partial answers are
shuffled. More questions than the bound are cut into blocks, asked a few at a time, after a
few chunks have told how near the hits of each must be.
``nearest_chunks_by_cell`` looks only into the cells nearest to a question;
``nearest_chunks_by_code`` scans codes of a few bytes and reads vectors of candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.functions.bounds import pinned, small_rows, small_side
from narrascope.functions.byte_products import Asked, Columns, byte_products, columns, may_reach
from narrascope.schema import CATEGORY, TOP_K

PLACES = 6
RESIDENT_QUESTIONS = 16_384
CELL_TRAINING_ROWS = 1_000_000
CODE_TRAINING_ROWS = 20_000
#: Candidates by code for each answer wanted.
CANDIDATES = 10
#: Of the exact hits, so many are found by the cells that are probed.
RECALL = 0.9
RECALL_QUESTIONS = 1024
_CANDIDATES = 4
_SCORES_AT_ONCE = 1 << 21
#: Pairs whose vectors are fetched at once.
_PAIRS_AT_ONCE = 256
#: Questions from which it pays to round chunks to bytes for them.
_MANY_QUESTIONS = 256
#: What scoring a pair again costs, in products of a pair.
_PAIR_COST = 32
#: Chunks that are scored at once: the first of a category, and at most.
_FIRST_CHUNKS, _MOST_CHUNKS = 512, 4096
#: Above any distance in units of its last place.
_DISTANCES = 1 << 22
#: Of so many chunks one is met first, within bounds, to tell what is near.
_FIRST_OF, _LEAST_FIRST, _MOST_FIRST = 32, 1 << 14, 1 << 17
#: Times ``RESIDENT_QUESTIONS`` questions that a scan serves, and scans whose questions are in the driver.
_SHARES_OF_A_SCAN, _SCANS_AT_ONCE = 2, 2
#: Vectors made ready at once.
_VECTORS_AT_ONCE = 1024
_FEW_HITS = 100_000
#: Sets of keys that questions may ask for: two to this power, a scan each.
_MOST_KEYS = 6


def cosine_distance(a: Column, b: Column) -> Column:
    """Distance of two vector columns in Spark SQL; null for a zero or ill-sized vector."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    distance = F.round(F.lit(1.0) - F.try_divide(dot(a, b), norms), PLACES)
    return F.when(F.size(a) == F.size(b), distance)


def _usable(vectors: pa.ListArray, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the vectors that have a direction and the wanted length, and their places."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    if dim is None:
        dim = int(lengths.max(initial=0))
    keep = np.flatnonzero(lengths == dim)
    if dim == 0 or not len(keep):
        return np.zeros((0, dim)), keep[:0]
    if len(keep) < len(lengths):
        vectors = vectors.take(pa.array(keep))
    rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    squares = np.einsum("ij,ij->i", rows, rows)
    usable = np.isfinite(squares) & (squares > 0)
    if not usable.all():
        # Very small and very large numbers leave the range of single precision.
        odd = np.flatnonzero(~usable)
        norms = np.linalg.norm(rows[odd].astype(np.float64), axis=1)
        usable[odd] = np.isfinite(norms) & (norms > 0)
        rows, keep = rows[usable], keep[usable]
    return rows, keep


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _lengths(rows: np.ndarray) -> np.ndarray:
    """What ``_unit`` divides rows by; few are in double precision at once."""
    lengths = np.empty(len(rows))
    for at in range(0, len(rows), _VECTORS_AT_ONCE):
        some = rows[at : at + _VECTORS_AT_ONCE].astype(np.float64)
        lengths[at : at + _VECTORS_AT_ONCE] = np.sqrt((some * some).sum(axis=1))
    return lengths


def _single(rows: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", rows, rows)
    if np.isfinite(squares).all() and (squares > 1e-30).all():
        return (rows / np.sqrt(squares)[:, None]).astype(np.float32)
    return _unit(rows).astype(np.float32)


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _places(similar: np.ndarray) -> np.ndarray:
    return np.rint((1.0 - similar) * 10**PLACES).astype(np.int64)


@dataclass
class _Questions:
    """Questions of one block: ids, vectors and the categories each asks for, null for any.

    No hit of a question is farther than its ``worst``, in units of the last place, where it is known.
    """

    ids: pa.Array
    wanted: pa.Array
    rows: np.ndarray
    worst: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table) -> _Questions:
        vectors = _column(table, "question_vector")
        lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
        _one_length((lengths["min"], lengths["max"]))
        rows, kept = _usable(vectors, None)
        worst = _column(table, "worst").to_numpy()[kept] if "worst" in table.column_names else None
        kept = pa.array(kept)
        return cls(_column(table, "question_id").take(kept), _column(table, "wanted").take(kept), rows, worst)

    @cached_property
    def lengths(self) -> np.ndarray:
        return _lengths(self.rows)

    @cached_property
    def bytes(self) -> Asked:
        return Asked.of(self.rows if self.are_single else _single(self.rows))

    @cached_property
    def are_single(self) -> bool:
        """Whether the rows are at unit length in single precision as they are."""
        return self.rows.dtype == np.float32 and bool((np.abs(self.lengths - 1) < np.finfo(np.float32).eps).all())

    def single(self, places: np.ndarray) -> np.ndarray:
        rows = self.rows.take(places, axis=0)
        return rows if self.are_single else _single(rows)

    @cached_property
    def groups(self) -> dict[str | None, np.ndarray]:
        """The places of the questions that ask for each category."""
        places: dict[str | None, list[int]] = {}
        for place, wanted in enumerate(self.wanted.to_pylist()):
            for category in [None] if wanted is None else wanted:
                places.setdefault(category, []).append(place)
        return {category: np.array(found) for category, found in places.items()}


class _Chunks:
    """Usable chunks of one batch, at unit length in the precision that is asked for."""

    def __init__(self, ids: pa.Array, rows: np.ndarray):
        self.ids, self.rows = ids, rows

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, places: np.ndarray) -> _Chunks:
        return _Chunks(self.ids.take(pa.array(places)), self.rows[places])

    def slice(self, start: int, end: int) -> _Chunks:
        return _Chunks(self.ids.slice(start, end - start), self.rows[start:end])

    @cached_property
    def double(self) -> np.ndarray:
        return _unit(self.rows)

    @cached_property
    def single(self) -> np.ndarray:
        return _single(self.rows)

    @cached_property
    def bytes(self) -> list[Columns]:
        return columns(self.single)

    @cached_property
    def id_order(self) -> np.ndarray:
        order = np.empty(len(self), np.int64)
        order[pc.sort_indices(self.ids, null_placement="at_start").to_numpy()] = np.arange(len(self))
        return order


class _Best:
    """The k best chunks per question seen so far by one task.

    ``worst`` is the k-th best distance of each question, in units of the last place kept.
    Once it is known, a slice of a batch costs one matrix product and one comparison, and only
    chunks that can still enter the ranking are looked at further. The first slices of a category
    are short and each is as long as all before it, so that few chunks are ranked unseen.
    """

    def __init__(self, questions: _Questions, k: int):
        self.k = k
        self.questions = questions
        self.dim = questions.rows.shape[1]
        # A distance is rounded by less than its last place, besides the error of a product.
        self.slack = 1.0 / 10**PLACES + 2 * self.dim * np.finfo(np.float32).eps
        self.worst = np.full(len(questions.rows), np.inf) if questions.worst is None else questions.worst.copy()
        known = {c: np.isfinite(self.worst[places]).all() for c, places in questions.groups.items()}
        self.seen = {category: _MOST_CHUNKS if known[category] else 0 for category in known}
        # Rows in the order of questions: place of the question, distance, place among the ids.
        self.question, self.distance, self.id_at = (np.empty(0, np.int64) for _ in range(3))
        self.ids: pa.Array | None = None

    def offer(self, batch: pa.Table | pa.RecordBatch):
        _offer([self], batch)

    def add(self, category: str | None, part: _Chunks):
        """Rank the chunks of one slice for the questions that ask for their category."""
        asked = self.questions.groups[category]
        step = max(1, _SCORES_AT_ONCE // len(part))
        step = -(-len(asked) // -(-len(asked) // step))
        found = [self._candidates(asked[at : at + step], part) for at in range(0, len(asked), step)]
        self._rank(*(np.concatenate(columns) for columns in zip(*found)), part.ids)
        self.seen[category] += len(part)

    def _rank(self, question: np.ndarray, distance: np.ndarray, column: np.ndarray, ids: pa.Array):
        """Take candidates of one slice, of chunks with these ids, into the ranking."""
        if not len(question):
            return
        used, at = np.unique(column, return_inverse=True)
        ids = ids.take(pa.array(used))
        before = 0 if self.ids is None else len(self.ids)
        self.ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        # Only questions that have candidates are ranked again.
        touched = np.zeros(len(self.worst), bool)
        touched[question] = True
        again = touched[self.question]
        old = self.question, self.distance, self.id_at
        question, distance, id_at = (
            np.concatenate([mine[again], new]) for mine, new in zip(old, (question, distance, at + before))
        )
        question, distance, id_at = self._first(question, distance, id_at)
        full = np.flatnonzero(_place_in_run(question) == self.k - 1)
        self.worst[question[full]] = np.minimum(self.worst[question[full]], distance[full])
        new = question, distance, id_at
        self.question, self.distance, self.id_at = (np.concatenate([mine[~again], n]) for mine, n in zip(old, new))
        if len(self.ids) > 2 * len(self.question):
            used, self.id_at = np.unique(self.id_at, return_inverse=True)
            self.ids = self.ids.take(pa.array(used))

    def _first(self, question: np.ndarray, distance: np.ndarray, id_at: np.ndarray):
        """The k first rows of each question, by distance and among equal ones by id."""
        key = question * _DISTANCES + distance
        order = np.argsort(key, kind="stable")
        key, id_at = key[order], id_at[order]
        place = _place_in_run(key // _DISTANCES)
        # Ids only decide where equal distances lie on both sides of the last place.
        last = np.flatnonzero(place == self.k)
        tied = np.flatnonzero(np.isin(key, key[last[key[last] == key[last - 1]]]))
        if tied.size:
            rows = pa.table({"key": key[tied], "id": self.ids.take(pa.array(id_at[tied]))})
            by_id = pc.sort_indices(rows, [("key", "ascending"), ("id", "ascending")], null_placement="at_start").to_numpy()
            id_at[tied] = id_at[tied][by_id]
        keep = place < self.k
        return key[keep] // _DISTANCES, key[keep] % _DISTANCES, id_at[keep]

    def _candidates(self, asked: np.ndarray, chunks: _Chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of questions, distances and places of chunks that may be ranked."""
        row, column = self._near(asked, chunks)
        if row is not None:
            distance = _places(self._exact(asked[row], chunks, column))
            enters = distance <= self.worst[asked[row]]
            return asked[row[enters]], distance[enters], column[enters]
        every = _unit(self.questions.rows[asked]) @ chunks.double.T
        # Distance and id in one integer: no ties, however many copies a chunk has.
        order = _places(every) * len(chunks) + chunks.id_order
        k = min(self.k, len(chunks))
        column = np.argpartition(order, k - 1, axis=1)[:, :k].ravel()
        row = np.repeat(np.arange(len(asked)), k)
        return asked[row], _places(every[row, column]), column

    def _near(self, asked: np.ndarray, chunks: _Chunks):
        """Pairs that can still be ranked, or nothing when they are not few.

        A product of bytes or in single precision decides, with slack for rounding and for its
        error; the pairs it lets through are scored again in double precision. A question that
        has not seen k chunks yet goes by the k-th best of these.
        """
        worst = self.worst[asked]
        unknown = np.flatnonzero(np.isinf(worst))
        if len(unknown) and len(chunks) <= self.k:
            return None, None
        floor, single = 1.0 - worst / 10**PLACES, self.questions.single(asked)
        if not len(unknown) and len(asked) >= _MANY_QUESTIONS and byte_products(self.dim):
            row, column = self._near_by_bytes(asked, single, chunks, floor - self.slack)
            if row is not None:
                return row, column
        similar = single @ chunks.single.T
        if len(unknown):
            seen = similar if len(unknown) == len(asked) else similar[unknown]
            floor[unknown] = np.partition(seen, len(chunks) - self.k, axis=1)[:, len(chunks) - self.k]
        near = similar >= (floor - self.slack).astype(np.float32)[:, None]
        if np.count_nonzero(near) > _CANDIDATES * self.k * len(asked):
            return None, None
        return np.divmod(_true_places(near), len(chunks))

    def _near_by_bytes(self, asked: np.ndarray, single: np.ndarray, chunks: _Chunks, floor: np.ndarray):
        """Pairs whose product may be ``floor``, or nothing when one in single precision costs less.

        Pairs that bytes let through are scored in single precision first.
        """
        own, most, found = self.questions.bytes.take(asked), len(asked) * len(chunks) // _PAIR_COST, []
        for cut in chunks.bytes:
            row, column = np.divmod(_true_places(may_reach(own, cut, floor)), len(cut.places))
            most -= len(row)
            if most < 0:
                return None, None
            column = cut.places[column]
            near = _products(single, row, chunks.single, column) >= floor[row]
            found.append((row[near], column[near]))
        return tuple(np.concatenate(places) for places in zip(*found))

    def _exact(self, question: np.ndarray, chunks: _Chunks, column: np.ndarray) -> np.ndarray:
        """Products of pairs at unit length in double precision."""
        asked, out = self.questions, np.empty(len(question))
        left, right = np.empty((2, min(len(out), _PAIRS_AT_ONCE), self.dim))
        for at in range(0, len(out), _PAIRS_AT_ONCE):
            end = min(len(out), at + _PAIRS_AT_ONCE)
            x, y, places = left[: end - at], right[: end - at], question[at:end]
            np.divide(asked.rows.take(places, axis=0).astype(np.float64), asked.lengths[places, None], out=x)
            chunks.double.take(column[at:end], axis=0, out=y, mode="clip")
            np.einsum("ij,ij->i", x, y, out=out[at:end])
        return out

    def table(self) -> pa.Table | None:
        if self.ids is None:
            return None
        return pa.table(
            {
                "question_id": self.questions.ids.take(pa.array(self.question)),
                "chunk_id": self.ids.take(pa.array(self.id_at)),
                "distance": pa.array(self.distance / 10**PLACES),
            }
        )


def _offer(blocks: Sequence[_Best], batch: pa.Table | pa.RecordBatch):
    """Rank the chunks of a batch for every block of questions; a slice is made ready once for all."""
    blocks = [best for best in blocks if len(best.worst)]
    if not blocks:
        return
    rows, kept = _usable(_column(batch, "chunk_vector"), blocks[0].dim)
    if not len(kept):
        return
    kept = pa.array(kept)
    chunks, held = _Chunks(_column(batch, "chunk_id").take(kept), rows), None
    for category in dict.fromkeys(category for best in blocks for category in best.questions.groups):
        asking = [best for best in blocks if category in best.questions.groups]
        found = chunks
        if category is not None:
            if held is None:
                held = _column(batch, "chunk_category").take(kept).dictionary_encode()
                names = held.dictionary.to_pylist()
                held = held.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            if category not in names:
                continue
            found = chunks.take(np.flatnonzero(held == names.index(category)))
        start = 0
        while start < len(found):
            end = min(len(found), start + min(max(asking[0].seen[category], _FIRST_CHUNKS), _MOST_CHUNKS))
            part = found.slice(start, end)
            for best in asking:
                best.add(category, part)
            start = end


def _products(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    """Products of pairs of rows. Few are fetched at a time, into memory that is used again."""
    out = np.empty(len(a_at), a.dtype)
    left, right = np.empty((2, min(len(out), _PAIRS_AT_ONCE), a.shape[1]), a.dtype)
    for at in range(0, len(out), _PAIRS_AT_ONCE):
        end = min(len(out), at + _PAIRS_AT_ONCE)
        x, y = left[: end - at], right[: end - at]
        a.take(a_at[at:end], axis=0, out=x, mode="clip")
        b.take(b_at[at:end], axis=0, out=y, mode="clip")
        np.einsum("ij,ij->i", x, y, out=out[at:end])
    return out


def _true_places(flags: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` for flags few of which are set: 64 are passed over at a time, in eights from all over."""
    flat = flags.ravel()
    whole = len(flat) - len(flat) % 64
    words = flat[:whole].view(np.uint64).reshape(8, -1)
    some = np.flatnonzero(np.bitwise_or.reduce(words, axis=0))
    part, at = np.nonzero(words[:, some])
    word = part * words.shape[1] + some[at]  # in order, as parts are
    found, at = np.nonzero(flat[:whole].reshape(-1, 8)[word])
    return np.concatenate([word[found] * 8 + at, whole + np.flatnonzero(flat[whole:])])


def _place_in_run(values: np.ndarray) -> np.ndarray:
    """Place of each of sorted values among its equals."""
    at = np.arange(len(values))
    begins = np.r_[True, values[1:] != values[:-1]][: len(values)]
    return at - np.maximum.accumulate(np.where(begins, at, 0))


def _partial_schema(questions: DataFrame, store: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("question_id", questions.schema["question_id"].dataType),
            T.StructField("chunk_id", store.schema["chunk_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _top(partial: DataFrame, k: int) -> DataFrame:
    """Final ranks. A row number bounded by a constant is cut map-side as well."""
    order = Window.partitionBy("question_id").orderBy("distance", "chunk_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("question_id", "rank", "chunk_id", "distance")
    )


def _ask(df: DataFrame, ident: str, vector: str, category: str | None) -> DataFrame:
    # An empty category asks for no filter.
    wanted = F.nullif(F.col(category).cast("string"), F.lit("")) if category else F.lit(None)
    return df.select(
        F.col(ident).alias("question_id"),
        wanted.cast("string").alias("wanted_category"),
        F.col(vector).alias("question_vector"),
    )


def _wanting(asked: DataFrame, wanted: Column) -> DataFrame:
    """Questions with the array of categories each asks for, null for any."""
    return asked.select("question_id", wanted.cast("array<string>").alias("wanted"), "question_vector")


def _hold(df: DataFrame, ident: str, vector: str, category: str | None, *others: str) -> DataFrame:
    held = F.col(category) if category else F.lit(None)
    return df.select(
        F.col(ident).alias("chunk_id"),
        held.cast("string").alias("chunk_category"),
        F.col(vector).alias("chunk_vector"),
        *others,
    )


def _few(hits: DataFrame, questions: int, k: int) -> DataFrame:
    """Hits marked for broadcast when their number, at most k per question, is small.

    Joining texts to them then leaves the chunk table where it lies.
    """
    return F.broadcast(hits) if questions * k <= _FEW_HITS else hits


def nearest_chunks(
    questions: DataFrame,
    store: DataFrame,
    k: int | None = TOP_K,
    *,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    question_category: str | None = None,
    chunk_id: str = "chunk_id",
    chunk_vector: str = "embedding",
    chunk_category: str = CATEGORY,
    resident_limit: int = RESIDENT_QUESTIONS,
) -> DataFrame:
    """Exact top ``k`` as ``(question_id, rank, chunk_id, distance)``.

    ``question_category`` names a question column; where it holds a value, only chunks of
    that category are ranked. No ``k``, or zero, means the default. Zero vectors, null
    vectors and vectors of another length are never returned. Question vectors of different
    lengths are an error.

    Up to ``resident_limit`` questions are kept in every task and the store is scanned once;
    more are taken in blocks of that size, with a scan for each, or for as many small ones as
    have ``RESIDENT_QUESTIONS`` questions. Results are the same.
    """
    k = k or TOP_K
    asked = _ask(questions, question_id, question_vector, question_category)
    held = _hold(store, chunk_id, chunk_vector, chunk_category if question_category else None)
    one = F.when(F.col("wanted_category").isNotNull(), F.array("wanted_category"))
    partial, questions = _score(_wanting(asked, one), held, k, resident_limit)
    return _few(_top(partial, k), questions, k)


def nearest_chunks_matching(
    questions: DataFrame,
    store: DataFrame,
    keys: Sequence[str],
    k: int | None = TOP_K,
    *,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    chunk_id: str = "chunk_id",
    chunk_vector: str = "embedding",
    resident_limit: int = RESIDENT_QUESTIONS,
) -> DataFrame:
    """Exact top ``k`` among the chunks that agree with a question in all ``keys`` it gives.

    ``keys`` are columns of both tables, compared as text; a null asks for no filter, and a chunk
    without a value agrees with no question that asks for one. Questions that give the same keys
    are ranked in one scan of the store, so there are as many scans as sets of keys are asked for.
    """
    k = k or TOP_K
    if len(keys) > _MOST_KEYS:
        raise ValueError(f"{len(keys)} keys, more than {_MOST_KEYS}")
    given = [F.col(f"`{key}`").isNotNull().alias(f"_{i}") for i, key in enumerate(keys)]
    parts = []
    for asked in questions.select(*given).distinct().collect():
        chosen = [key for key, is_given in zip(keys, asked) if is_given]
        same = reduce(lambda a, b: a & b, (F.col(f"`{key}`").isNotNull() == F.lit(x) for key, x in zip(keys, asked)), F.lit(True))
        value = F.to_json(F.array(*[F.col(f"`{key}`").cast("string") for key in chosen])) if chosen else F.lit(None)
        parts.append(nearest_chunks(
            questions.where(same).withColumn("_wanted", value.cast("string")),
            store.withColumn("_wanted", value.cast("string")) if chosen else store,
            k, question_id=question_id, question_vector=question_vector, chunk_id=chunk_id, chunk_vector=chunk_vector,
            question_category="_wanted" if chosen else None, chunk_category="_wanted", resident_limit=resident_limit,
        ))
    if not parts:
        return nearest_chunks(questions, store, k, question_id=question_id, question_vector=question_vector,
                              chunk_id=chunk_id, chunk_vector=chunk_vector)
    return reduce(DataFrame.unionByName, parts)


def _score(asked: DataFrame, held: DataFrame, k: int, limit: int) -> tuple[DataFrame, int]:
    """Partial answers, from one scan of the chunks for each ``limit`` questions, and their number."""
    resident = small_rows(asked, limit)
    if resident is not None:
        return _score_resident(resident, asked, held, k), resident.num_rows
    asked = pinned(asked, "questions")
    number = asked.count()
    return _score_question_blocks(asked, number, held, k, limit), number


def _score_question_blocks(asked: DataFrame, number: int, held: DataFrame, k: int, size: int) -> DataFrame:
    """Answers of any number of written questions, in blocks of ``size`` at most.

    A scan of the store serves as many blocks as have a few times ``RESIDENT_QUESTIONS`` questions,
    so the number of scans does not grow as blocks get smaller. Questions are drawn by hash of
    the row's place, so scans are even whatever ids repeat. The questions of two scans at a time
    are in the driver. So the driver and a task hold a bounded number of questions. No chunk
    vector is shuffled but those of a few that are asked first; the questions of a scan are
    bounded but for the draw.
    """
    most = max(size, _SHARES_OF_A_SCAN * RESIDENT_QUESTIONS)
    scans = -(-number // most)
    _one_length(asked.agg(F.min(F.size("question_vector")), F.max(F.size("question_vector"))).head())
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(scans))
    drawn = pinned(asked.withColumn("scan", drawn.cast("int")), "question-blocks")
    few = _first_chunks(held)

    @inheritable_thread_target(asked.sparkSession)
    def answer(scan: int) -> DataFrame | None:
        resident = drawn.where(F.col("scan") == scan).drop("scan").toArrow()
        if not resident.num_rows:
            return None
        if few is not None:
            resident = resident.append_column("worst", _bounds(resident, few, k, size))
        best = _top(_score_resident(resident, asked, held, k, size), k)
        return pinned(best.drop("rank"), "block-answers")

    # The last tasks of a scan leave cores to the next one.
    with ThreadPoolExecutor(_SCANS_AT_ONCE) as pool:
        parts = [part for part in pool.map(answer, range(scans)) if part is not None]
    return reduce(DataFrame.unionByName, parts)


def _first_chunks(held: DataFrame) -> DataFrame | None:
    """A few of very many chunks, written, to be met by all questions before all chunks are."""
    total = held.count()
    few = min(max(total // _FIRST_OF, _LEAST_FIRST), _MOST_FIRST)
    if total < 8 * few:
        return None
    tasks = held.sparkSession.sparkContext.defaultParallelism
    return pinned(held.sample(few / total, seed=42).repartition(tasks), "first-chunks")


def _bounds(resident: pa.Table, few: DataFrame, k: int, size: int) -> pa.Array:
    """The k-th best distance of each question among a few chunks, infinite where they are fewer than k.

    The k best of all chunks are no farther, so a task that knows it need not find out by itself
    what is near; it still scores all of its chunks. Questions go by place, as ids may repeat.
    """
    numbered = resident.set_column(resident.schema.get_field_index("question_id"), "question_id", pa.array(range(resident.num_rows), pa.int64()))
    asked = few.select(F.lit(0).cast("long").alias("question_id"))
    last = _top(_score_resident(numbered, asked, few, k, size), k).where(F.col("rank") == k).toArrow()
    worst = np.full(resident.num_rows, np.inf)
    worst[last.column("question_id").to_numpy()] = np.rint(last.column("distance").to_numpy() * 10**PLACES)
    return pa.array(worst)


def _one_length(found) -> None:
    """Question vectors have the length of the store's; two lengths are an error."""
    if found[0] is not None and found[0] != found[1]:
        raise ValueError(f"question vectors of different lengths, from {found[0]} to {found[1]}")


def _score_resident(resident: pa.Table, asked: DataFrame, held: DataFrame, k: int, size: int | None = None) -> DataFrame:
    """Answers of one scan of the chunks to resident questions, ranked in blocks of ``size`` at most."""
    lists = resident.column("wanted").combine_chunks()
    if len(lists) and not lists.null_count:
        # As a literal list this prunes the partitions of a store laid out by category.
        held = held.where(F.col("chunk_category").isin(*sorted(set(lists.flatten().to_pylist()))))
    number = max(1, resident.num_rows)
    step = -(-number // -(-number // (size or number)))
    blocks = [_Questions.of(resident.slice(at, step).combine_chunks()) for at in range(0, number, step)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(block, k) for block in blocks]
        for batch in batches:
            _offer(best, batch)
        for answer in (one.table() for one in best):
            if answer is not None:
                yield from answer.to_batches()

    return held.mapInArrow(score, _partial_schema(asked, held))


def _usable_vectors(vector: str) -> Column:
    """Vectors with a direction: neither null nor zero, and every number finite."""
    finite = F.forall(vector, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def train_cells(
    store: DataFrame,
    cells: int,
    *,
    seed: int = 42,
    chunk_vector: str = "embedding",
    max_iter: int = 10,
    most_rows: int = CELL_TRAINING_ROWS,
) -> np.ndarray:
    """Centres, one per row, of the directions of the store's vectors.

    At most about ``most_rows`` vectors, drawn at random, place them; every chunk is
    assigned to a cell whatever was drawn. Vectors without a direction, or not of the length
    that most have, are left out.
    """
    usable = store.where(_usable_vectors(chunk_vector))
    length = F.size(chunk_vector)
    common = usable.groupBy(length.alias("dim")).count().orderBy(F.desc("count"), "dim").head()
    usable = usable.where(length == common["dim"])
    if common["count"] > most_rows:
        usable = usable.sample(most_rows / common["count"], seed=seed)
    vectors = usable.select(array_to_vector(F.col(chunk_vector)).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(vectors)
    model = KMeans(k=cells, seed=seed, maxIter=max_iter).fit(unit)
    return np.asarray(model.clusterCenters())


def assign_cells(store: DataFrame, centres: np.ndarray, *, chunk_vector: str = "embedding") -> DataFrame:
    """The store with the ``cell`` of each chunk, that of the nearest centre.

    Vectors without a direction or of another length have no cell and are in -1.
    """
    nearest = _nearest_cells(F.col(chunk_vector), centres, 1)
    return store.withColumn("cell", F.coalesce(F.get(nearest, F.lit(0)), F.lit(-1)))


def enough_probes(
    questions: DataFrame,
    store: DataFrame,
    centres: np.ndarray,
    k: int | None = TOP_K,
    recall: float = RECALL,
    *,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    question_category: str | None = None,
    chunk_id: str = "chunk_id",
    chunk_vector: str = "embedding",
    chunk_category: str = CATEGORY,
    most_questions: int = RECALL_QUESTIONS,
) -> tuple[int, float]:
    """The fewest cells to probe for ``recall`` of the exact top ``k``, and the recall measured.

    At most ``most_questions`` questions, drawn by hash, are asked exactly; each true hit
    tells, by the place of its cell among those nearest to the question, from how many
    probes on it is found. Ids of chunks are taken to be unique. Without hits, every cell.
    """
    asked = _ask(questions, question_id, question_vector, question_category)
    asked = asked.orderBy(F.xxhash64("question_id", "question_vector")).limit(most_questions)
    asked = pinned(asked.withColumn("number", F.monotonically_increasing_id()), "asked")
    held = _hold(store, chunk_id, chunk_vector, chunk_category if question_category else None, "cell")
    hits = nearest_chunks(
        asked, held, k, question_id="number", question_vector="question_vector",
        question_category="wanted_category", chunk_vector="chunk_vector", chunk_category="chunk_category",
    )
    cells = asked.select(
        F.col("number").alias("question_id"),
        _nearest_cells(F.col("question_vector"), centres, len(centres)).alias("cells"),
    )
    # Hits are few: k for each question asked.
    found = held.select("chunk_id", "cell").join(F.broadcast(hits), "chunk_id").join(F.broadcast(cells), "question_id")
    places = found.groupBy(F.array_position("cells", F.col("cell")).alias("place")).count().collect()
    counts = np.zeros(len(centres) + 1)
    for row in places:
        counts[row["place"]] = row["count"]
    if not counts.sum():
        return len(centres), 1.0
    reached = np.cumsum(counts[1:]) / counts.sum()
    probes = min(int(np.searchsorted(reached, recall)) + 1, len(centres))
    return probes, float(reached[probes - 1])


def nearest_chunks_by_cell(
    questions: DataFrame,
    store: DataFrame,
    centres: np.ndarray,
    k: int | None = TOP_K,
    probes: int | None = None,
    *,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    question_category: str | None = None,
    chunk_id: str = "chunk_id",
    chunk_vector: str = "embedding",
    chunk_category: str = CATEGORY,
    resident_limit: int = RESIDENT_QUESTIONS,
) -> DataFrame:
    """Approximate top ``k`` from the ``probes`` cells nearest to each question.

    Without ``probes``, as many as ``enough_probes`` measures. Probing every cell gives the
    exact answer. A question asks for its cells like for
    categories, so it is held once however many it probes, chunks are scored where they lie and
    only cells that some question probes are read.
    """
    k = k or TOP_K
    if probes is None:
        probes, _ = enough_probes(
            questions, store, centres, k, question_id=question_id, question_vector=question_vector,
            question_category=question_category, chunk_id=chunk_id, chunk_vector=chunk_vector,
            chunk_category=chunk_category,
        )
    asked = _ask(questions, question_id, question_vector, question_category)
    asked = asked.withColumn("cells", _nearest_cells(F.col("question_vector"), centres, probes))
    asked = pinned(asked.where(F.size("cells") > 0), "visits")
    category = chunk_category if question_category else None
    held = _hold(store, chunk_id, chunk_vector, category, "cell")
    # There are no more probed cells than centres, which the driver holds anyway.
    visited = [row.cell for row in asked.select(F.explode("cells").alias("cell")).distinct().collect()]
    held = held.where(F.col("cell").isin(visited))
    parts, number = [], 0
    for open_to_all in (True, False) if question_category else (True,):
        own = asked.where(F.col("wanted_category").isNull() == F.lit(open_to_all))
        wanted, name = F.col("cells"), [F.col("cell").cast("string")]
        if not open_to_all:
            wanted = F.transform("cells", lambda cell: F.concat_ws(" ", cell, F.col("wanted_category")))
            name.append(F.coalesce("chunk_category", F.lit("")))
        holding = held.withColumn("chunk_category", F.concat_ws(" ", *name)).drop("cell")
        partial, own_number = _score(_wanting(own, wanted), holding, k, resident_limit)
        parts.append(partial)
        number += own_number
    return _few(_top(reduce(DataFrame.unionByName, parts), k), number, k)


def _nearest_cells(vector: Column, centres: np.ndarray, probes: int) -> Column:
    probes = min(probes, len(centres))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(vectors: pa.Array) -> pa.Array:
        rows, kept = _usable(vectors, centres.shape[1])
        # For one question the squared distance to a centre grows with this.
        far = (centres * centres).sum(axis=1) - 2.0 * _unit(rows) @ centres.T
        found = np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32)
        lengths = np.zeros(len(vectors), np.int32)
        lengths[kept] = probes
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return nearest(vector)


@dataclass
class Codebooks:
    """Centres of each part of a vector: (parts, 256 at most, numbers of a part)."""

    centres: np.ndarray

    @property
    def dim(self) -> int:
        return self.centres.shape[0] * self.centres.shape[2]

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """The nearest centre of each part, a byte each."""
        parts = rows.reshape(len(rows), self.centres.shape[0], -1)
        codes = np.empty(parts.shape[:2], np.uint8)
        for j, centres in enumerate(self.centres):
            far = (centres * centres).sum(axis=1) - 2.0 * parts[:, j] @ centres.T
            codes[:, j] = np.argmin(far, axis=1)
        return codes

    def decode(self, codes: np.ndarray) -> np.ndarray:
        found = self.centres[np.arange(self.centres.shape[0]), codes]
        return found.reshape(len(codes), self.dim).astype(np.float32)


def train_codes(
    store: DataFrame,
    parts: int,
    *,
    seed: int = 42,
    chunk_vector: str = "embedding",
    most_rows: int = CODE_TRAINING_ROWS,
    rounds: int = 12,
) -> Codebooks:
    """Codebooks of the directions of the store's vectors, cut into ``parts`` equal parts.

    At most about ``most_rows`` vectors, drawn at random, are fetched to place the centres; every
    vector gets its code whatever was drawn.
    """
    usable = store.where(_usable_vectors(chunk_vector))
    dim, total = usable.agg(F.mode(F.size(chunk_vector)), F.count("*")).head()
    if not total or dim % parts:
        raise ValueError(f"{total} vectors of {dim} numbers cannot be cut into {parts} parts")
    if total > most_rows:
        usable = usable.sample(most_rows / total, seed=seed)
    drawn = usable.where(F.size(chunk_vector) == dim).select(chunk_vector).limit(2 * most_rows).toArrow()
    rows, _ = _usable(_column(drawn, chunk_vector), dim)
    rows, rng = _unit(rows).reshape(-1, parts, dim // parts), np.random.default_rng(seed)
    books = []
    for j in range(parts):
        part = rows[:, j]
        centres = part[rng.choice(len(part), min(256, len(part)), replace=False)]
        for _ in range(rounds):
            near = np.argmin((centres * centres).sum(axis=1) - 2.0 * part @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, part)
            sizes = np.bincount(near, minlength=len(centres))[:, None]
            centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres)
        books.append(centres)
    return Codebooks(np.stack(books))


def vector_codes(vector: Column, books: Codebooks) -> Column:
    """A vector's code, null without a direction or of another length."""

    @F.arrow_udf(T.BinaryType())
    def encode(vectors: pa.Array) -> pa.Array:
        rows, kept = _usable(vectors, books.dim)
        out = np.full(len(vectors), None, object)
        out[kept] = [code.tobytes() for code in books.encode(_unit(rows))]
        return pa.array(out.tolist(), pa.binary())

    return encode(vector)


def _decoded(code: Column, books: Codebooks) -> Column:
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def decode(codes: pa.Array) -> pa.Array:
        present = codes.drop_null()
        flat = np.frombuffer(b"".join(present.to_pylist()), np.uint8).reshape(len(present), -1)
        lengths = np.where(codes.is_valid().to_numpy(zero_copy_only=False), books.dim, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(books.decode(flat).ravel()))

    return decode(code)


def nearest_chunks_by_code(
    questions: DataFrame,
    codes: DataFrame,
    store: DataFrame,
    books: Codebooks,
    k: int | None = TOP_K,
    candidates: int | None = None,
    *,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    question_category: str | None = None,
    chunk_id: str = "chunk_id",
    chunk_vector: str = "embedding",
    chunk_category: str = CATEGORY,
    resident_limit: int = RESIDENT_QUESTIONS,
) -> DataFrame:
    """Approximate top ``k``: the best ``candidates`` by ``codes`` (chunk id, ``code``, category),
    ranked by their vectors in ``store``. Ids of chunks are taken to be unique.

    Codes are a byte for each part, so a scan over them reads little; a code stands for the vector
    of its centres. Without a number, ten candidates for each answer.
    """
    k = k or TOP_K
    coded = codes.where("code IS NOT NULL").withColumn(chunk_vector, _decoded(F.col("code"), books))
    near = nearest_chunks(
        questions, coded, candidates or CANDIDATES * k, question_id=question_id, question_vector=question_vector,
        question_category=question_category, chunk_id=chunk_id, chunk_vector=chunk_vector,
        chunk_category=chunk_category, resident_limit=resident_limit,
    ).select("question_id", "chunk_id")
    asked = questions.select(F.col(question_id).alias("question_id"), F.col(question_vector).alias("question_vector"))
    vectors = store.select(F.col(chunk_id).alias("chunk_id"), F.col(chunk_vector).alias("chunk_vector"))
    scored = vectors.join(near, "chunk_id").join(small_side(asked, resident_limit), "question_id").select(
        "question_id", "chunk_id", cosine_distance(F.col("question_vector"), F.col("chunk_vector")).alias("distance")
    )
    return _top(scored.where("distance IS NOT NULL"), k)
