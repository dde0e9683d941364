"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cut the same bytes, a space and the text, so the ends of their tokens are two
rising sequences. Places where tokens of both end cut them into groups, which is a merge. Its
work is the number of ends. A diagonal is all pairs (i, j) of ends taken so far with the same
sum; a binary search along it finds the one pair that the merge passes, so diagonals at equal
distances divide the merge into pieces of equal work that know nothing of each other. A
document of more than one piece is dealt out by piece; small documents are merged a batch at a
time, by the same pieces, as a document's end is an end of both. A piece gives the groups that
it closes, its links, and the tokens left open at its border, which are stitched to those of
the next piece.

Links are the pairs of tokens that end together. How often a pair of ids is linked in the whole
corpus is counted from blocks: a block numbers its different pairs, so only those are exchanged
between tasks, once a block, and come back with their count.

Defined results: null and empty texts, and texts that the tokens of either tokenizer do not
spell out byte by byte (such as those with U+2581), have no tokens and count zero, their groups
are empty; every row has its own result, also with a null or repeated id, and repeated rows all
count; an empty table gives an empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, keyed, slices
from narrascope.llm.tokens import Remembered, TextEncoder

#: Token ends in a piece of a merge.
PIECE_ENDS = 1 << 16
#: Words that each tokenizer remembers, and bytes of text that are encoded and merged at a time.
_WORDS, _BATCH_BYTES = 1 << 16, 1 << 20

_SPACE = "▁"


def _byte_characters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones of
    Latin-1 for themselves, the others in order from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens(TextEncoder):
    """Ids of a byte-level tokenizer that takes special strings as ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.words = Remembered(self._encode_plain, _WORDS)
        characters = _byte_characters()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [token.content.encode() for token in added.values()]
        names = [added[i].content if i in added else self.tokenizer.id_to_token(i) or "" for i in range(size)]
        known = [i not in added and all(c in characters for c in name) for i, name in enumerate(names)]
        self.bytes_of = pa.array([bytes(map(characters.get, n)) if ok else n.encode() for n, ok in zip(names, known)], pa.binary())

    def _encode_plain(self, words: list) -> list[bytes]:
        """Packed ids; special strings are known as such only to tell words apart."""
        words = [word.encode() if isinstance(word, str) else word for word in words]
        if self.cuttable and not any(special in word for special in self.special for word in words):
            return self._encode_words(words)
        self.tokenizer.encode_special_tokens = True
        found = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        self.tokenizer.encode_special_tokens = False
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.cuttable:
            return super().encode(texts)
        parts = self._encode_plain(texts.to_pylist())
        return np.frombuffer(b"".join(parts), "<u4"), np.array([len(part) // 4 for part in parts], np.int64)


class PieceTokens(TextEncoder):
    """Ids of a sentencepiece model that adds a space, for texts that have that space.

    No piece of such a model usually holds a space behind another character. Then no piece
    crosses from a word to the spaces behind it, and words can be encoded one at a time.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes_of = pa.array(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)],
            pa.binary(),
        )
        self.alone = self.model.piece_to_id(_SPACE)
        probe = "a  ﬁ b "
        self.cuttable = (
            not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
            and not self.model.is_unknown(self.alone)
            and b"".join(self.bytes_of[i].as_py() for i in self.model.encode(probe)) == f" {probe}".encode()
        )
        self.words = Remembered(self._encode_words, _WORDS)

    def _starts(self, data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        white = data == 32
        first = np.zeros(data.size, bool)
        first[1:] = white[1:] & ~white[:-1]
        first[text_starts[text_starts < data.size]] = True
        return np.flatnonzero(first)

    def _encode_words(self, words: list) -> list[bytes]:
        """Packed ids of words that begin with the space that the model adds."""
        words = [word.decode() if isinstance(word, bytes) else word for word in words]
        found = self.model.encode([word[1:] for word in words], num_threads=1)
        # The model adds no space to an empty text.
        return [np.array(ids if len(w) > 1 else [self.alone] * len(w), "<u4").tobytes() for w, ids in zip(words, found)]


@cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@cache
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def path_cuts(a_ends: np.ndarray, b_ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of either sequence each piece has behind it, from (0, 0) to all.

    One binary search for each diagonal, all at a time; of equal ends that of ``a`` comes
    first, and both stay in one piece.
    """
    work = a_ends.size + b_ends.size
    sums = np.arange(most, work, most)
    low, high = np.maximum(0, sums - b_ends.size), np.minimum(sums, a_ends.size)
    while (searching := low < high).any():
        middle = (low + high) // 2
        a_first = a_ends[np.minimum(middle, a_ends.size - 1)] <= b_ends[np.maximum(sums - middle - 1, 0)]
        low = np.where(searching & a_first, middle + 1, low)
        high = np.where(searching & ~a_first, middle, high)
    i, j = low, sums - low
    parted = (i > 0) & (j < b_ends.size) if b_ends.size else np.zeros(i.size, bool)
    parted[parted] = a_ends[i[parted] - 1] == b_ends[j[parted]]
    return np.r_[0, i, a_ends.size], np.r_[0, j + parted, b_ends.size]


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that both sequences of one piece have."""
    if not a_ends.size or not b_ends.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(b_ends, a_ends), b_ends.size - 1)
    both = np.flatnonzero(b_ends[at] == a_ends)
    return both, at[both]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id below ``size`` as its decimal digits in a word of eight bytes, and its length."""
    texts = [b"%d" % i for i in range(size)]
    return np.array([t.ljust(8, b"\0") for t in texts], "S8").view("<u8"), np.array([len(t) for t in texts], np.uint64)


class _Writer:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size: int):
        if size > 10**7:
            raise ValueError("a vocabulary of more than 10,000,000 ids")
        self.digits, self.lengths = _digits(size)

    def _marked(self, ids: np.ndarray, last: np.ndarray, mark: str) -> np.ndarray:
        marks = np.where(last, np.uint64(ord(mark)), np.uint64(ord(",")))
        return self.digits[ids] | (marks << (np.uint64(8) * self.lengths[ids]))

    def write(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
        """Groups that end with those tokens of either, each with a semicolon behind it."""
        last_a, last_b = np.zeros(a.size, bool), np.zeros(b.size, bool)
        last_a[ends_a], last_b[ends_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(a.size + b.size, "<u8")
        out[np.arange(a.size) + np.r_[0, ends_b + 1][group_a]] = self._marked(a, last_a, "|")
        out[np.arange(b.size) + (ends_a + 1)[group_b]] = self._marked(b, last_b, ";")
        return out.tobytes().translate(None, b"\0")

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.lengths[ids].astype(np.int64) + 1


_DONE = "row long, n_a long, n_b long, n_groups long, groups string"
_LINKS = "block long, rows array<long>, sizes array<int>, which binary, pairs array<long>, counts array<long>"
_PIECE = "piece int, a array<int>, b array<int>, a_from long, b_from long"
_FIRST = f"{_DONE}, {_LINKS}, {_PIECE}"
_NULL = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
         "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _batch(schema: str, height: int, **columns) -> pa.RecordBatch:
    """A batch of ``schema`` with nulls in the columns that are not given."""
    fields = [field.split() for field in schema.split(", ")]
    arrays = [pa.array(columns[n], _NULL[k]) if n in columns else pa.nulls(height, _NULL[k]) for n, k in fields]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _linked(schema: str, block: int, rows: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    """The links of a block: its different pairs, and which of them each row has."""
    pairs, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    return _batch(schema, 1, block=[block], rows=[rows], sizes=[sizes], which=[which.astype("<i4").tobytes()],
                  pairs=[pairs], counts=[counts])


class _Aligner:
    def __init__(self, a_path: str, b_path: str, piece_ends: int, digest: bool):
        self.a, self.b = byte_tokens(a_path), piece_tokens(b_path)
        self.piece_ends, self.digest = piece_ends, digest
        self.a_sizes, self.b_sizes = (pc.binary_length(t.bytes_of).to_numpy().astype(np.int64) for t in (self.a, self.b))
        self.writer = _Writer(max(self.a_sizes.size, self.b_sizes.size))

    def _spelled(self, tokens, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Whether the tokens of each text are its bytes."""
        joined = tokens.bytes_of.cast(pa.large_binary()).take(pa.array(ids))
        flat = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        places = np.frombuffer(joined.buffers()[1], np.int64)[np.r_[0, np.cumsum(counts)]]
        same = np.diff(places) == np.diff(edges)
        if same.all():
            if np.array_equal(flat[: data.size], data):
                return same
        for i in np.flatnonzero(same):
            same[i] = np.array_equal(flat[places[i] : places[i + 1]], data[edges[i] : edges[i + 1]])
        return same

    def tokens(self, texts: pa.Array):
        """Ids and counts by either tokenizer; none for a text that has no tokens."""
        texts = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise("", texts, " ").cast(pa.large_binary())
        edges = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
        data = np.frombuffer(spaced.buffers()[2], np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        found, good = [], np.diff(edges) > 1
        for tokens in (self.a, self.b):
            strings = spaced.cast(pa.large_string())
            ids, counts = tokens.encode(strings)
            good &= self._spelled(tokens, ids, counts, data, edges)
            found.append((ids, counts))
        if not good.all():
            found = [(ids[np.repeat(good, counts)], np.where(good, counts, 0)) for ids, counts in found]
        return found

    def merged(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common ends of whole sequences, piece by piece."""
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        i, j = path_cuts(a_ends, b_ends, self.piece_ends)
        found = [common_ends(a_ends[p:q], b_ends[r:s]) for p, q, r, s in zip(i, i[1:], j, j[1:])]
        return np.concatenate([f[0] + p for f, p in zip(found, i)]), np.concatenate([f[1] + r for f, r in zip(found, j)])

    def batch(self, rows: np.ndarray, texts: pa.Array, block: int) -> Iterator[pa.RecordBatch]:
        """Small documents with their result, their links, and the pieces of large ones."""
        (a, a_counts), (b, b_counts) = self.tokens(texts)
        large = a_counts + b_counts > self.piece_ends
        if large.any():
            yield from self._pieces(rows, a, a_counts, b, b_counts, large)
            a, b = a[np.repeat(~large, a_counts)], b[np.repeat(~large, b_counts)]
            rows, a_counts, b_counts = rows[~large], a_counts[~large], b_counts[~large]
        ends_a, ends_b = self.merged(a, b)
        a_edges, b_edges = np.r_[0, np.cumsum(a_counts)], np.r_[0, np.cumsum(b_counts)]
        groups = np.diff(np.searchsorted(ends_a, a_edges))
        text = memoryview(self.writer.write(a, b, ends_a, ends_b))
        a_bytes, b_bytes = (np.r_[0, np.cumsum(self.writer.sizes(ids))] for ids in (a, b))
        places = (a_bytes[a_edges] + b_bytes[b_edges]).tolist()
        written = [bytes(text[s : e - 1]) if e > s else b"" for s, e in zip(places, places[1:])]
        if self.digest:
            written = [hashlib.sha256(w).hexdigest() if w else "" for w in written]
        else:
            written = [w.decode() for w in written]
        yield _batch(_FIRST, rows.size, row=rows, n_a=a_counts, n_b=b_counts, n_groups=groups, groups=written)
        if ends_a.size:
            pairs = (a[ends_a].astype(np.int64) << 32) | b[ends_b]
            yield _linked(_FIRST, block, rows, groups.astype(np.int32), pairs)

    def _pieces(self, rows, a, a_counts, b, b_counts, large) -> Iterator[pa.RecordBatch]:
        a_edges, b_edges = np.r_[0, np.cumsum(a_counts)], np.r_[0, np.cumsum(b_counts)]
        for at in np.flatnonzero(large):
            mine, other = a[a_edges[at] : a_edges[at + 1]], b[b_edges[at] : b_edges[at + 1]]
            a_ends, b_ends = np.cumsum(self.a_sizes[mine]), np.cumsum(self.b_sizes[other])
            i, j = path_cuts(a_ends, b_ends, self.piece_ends)
            starts_a, starts_b = np.r_[0, a_ends], np.r_[0, b_ends]
            for n, (p, q, r, s) in enumerate(zip(i, i[1:], j, j[1:])):
                yield _batch(_FIRST, 1, row=[rows[at]], piece=[n], a=[mine[p:q].astype(np.int32)], b=[other[r:s].astype(np.int32)],
                             a_from=[starts_a[p]], b_from=[starts_b[r]])

    def piece(self, row: int, n: int, a: np.ndarray, b: np.ndarray, a_from: int, b_from: int, block: int) -> Iterator[pa.RecordBatch]:
        """Closed groups as text; what is open at either border as ids joined by commas."""
        a_ends, b_ends = a_from + np.cumsum(self.a_sizes[a]), b_from + np.cumsum(self.b_sizes[b])
        ends_a, ends_b = common_ends(a_ends, b_ends)
        joined = lambda ids: ",".join(map(str, ids.tolist())) or None
        head_a = head_b = middle = None
        tail_a, tail_b = a, b
        if ends_a.size:
            p, r, q, s = ends_a[0] + 1, ends_b[0] + 1, ends_a[-1] + 1, ends_b[-1] + 1
            head_a, head_b = joined(a[:p]), joined(b[:r])
            middle = self.writer.write(a[p:q], b[r:s], ends_a[1:] - p, ends_b[1:] - r)[:-1].decode() or None
            tail_a, tail_b = a[q:], b[s:]
        yield _batch(_STITCH, 1, row=[row], n_a=[a.size], n_b=[b.size], n_groups=[ends_a.size], piece=[n], head_a=[head_a],
                     head_b=[head_b], middle=[middle], tail_a=[joined(tail_a)], tail_b=[joined(tail_b)])
        if ends_a.size:
            pairs = (a[ends_a].astype(np.int64) << 32) | b[ends_b]
            yield _linked(_STITCH, block, np.array([row]), np.array([ends_a.size], np.int32), pairs)


_STITCH = (f"row long, n_a long, n_b long, n_groups long, piece int, head_a string, head_b string, "
           f"middle string, tail_a string, tail_b string, {_LINKS}")


def _aligned(a_path: str, b_path: str, piece_ends: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _Aligner(a_path, b_path, piece_ends, digest), 2 * TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, 1, _BATCH_BYTES):
                yield from aligner.batch(part.column(0).to_numpy(), part.column(1), block)
                block += 1

    return run


def _merged_pieces(a_path: str, b_path: str, piece_ends: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Odd numbers in the upper half: blocks of pieces are others than those of batches.
        aligner, block = _Aligner(a_path, b_path, piece_ends, False), (2 * TaskContext.get().partitionId() + 1) << 32
        for batch in batches:
            row, n, a, b, a_from, b_from = (batch.column(c) for c in ("row", "piece", "a", "b", "a_from", "b_from"))
            for i in range(batch.num_rows):
                ids = (c[i].values.to_numpy() for c in (a, b))
                yield from aligner.piece(row[i].as_py(), n[i].as_py(), *ids, a_from[i].as_py(), b_from[i].as_py(), block)
                block += 1

    return run


def _stitched(pieces: DataFrame, digest: bool) -> DataFrame:
    """Groups of large documents from their pieces, in order.

    A piece's first group also has the tokens that were left open before it.
    """
    fields = ["piece", "n_groups", "head_a", "head_b", "middle", "tail_a", "tail_b"]
    whole = pieces.groupBy("row").agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("n_groups").alias("n_groups"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("all"),
    )
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("text"), none.alias("a"), none.alias("b"))

    def step(so_far, piece):
        first = F.concat(F.concat_ws(",", so_far["a"], piece["head_a"]), F.lit("|"), F.concat_ws(",", so_far["b"], piece["head_b"]))
        closed = F.struct(
            F.concat_ws(";", so_far["text"], first, piece["middle"]).alias("text"), piece["tail_a"].alias("a"), piece["tail_b"].alias("b")
        )
        both = lambda side: F.nullif(F.concat_ws(",", so_far[side], piece[f"tail_{side}"]), F.lit(""))
        still = F.struct(so_far["text"].alias("text"), both("a").alias("a"), both("b").alias("b"))
        return F.when(piece["n_groups"] > 0, closed).otherwise(still)

    text = F.aggregate("all", start, step)["text"]
    return whole.select("row", "n_a", "n_b", "n_groups", (F.sha2(text, 256) if digest else text).alias("groups"))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row of a block: links whose pair is its B id's best, and counts over links."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = {name: batch.column(name)[i] for name in batch.schema.names}
            rows, sizes = (one[c].values.to_numpy() for c in ("rows", "sizes"))
            which = np.frombuffer(one["which"].as_py(), "<i4")
            told = one["told"].values
            place, total, best = (told.field(c).to_numpy(zero_copy_only=False) for c in ("place", "total", "best"))
            totals, bests = np.empty(place.size, np.int64), np.empty(place.size, np.int64)
            totals[place], bests[place] = total, best
            ends = np.r_[0, np.cumsum(sizes)]
            sums = (np.diff(np.r_[0, np.cumsum(values[which])][ends]) for values in (bests, totals))
            yield pa.RecordBatch.from_arrays([pa.array(rows), *map(pa.array, sums)], ["row", "n_best", "count_sum"])


def align_tokenizers(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    piece_ends: int = PIECE_ENDS,
) -> tuple[DataFrame, DataFrame]:
    """Per document row_key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups; and the
    links of the corpus, (a_id, b_id, count, best).

    ``a_path`` is a byte-level file of the tokenizers library, ``b_path`` a sentencepiece model
    that adds a space, both on every executor. ``groups`` is text, ``a1,a2|b1;a3|b2``, or with
    ``digest`` its SHA-256 in hex, of which an empty text has none.
    """
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    first = pinned(texts.mapInArrow(_aligned(a_path, b_path, piece_ends, digest), _FIRST), "aligned")
    pieces = first.filter("piece IS NOT NULL").select("row", "piece", "a", "b", "a_from", "b_from")
    dealt = pieces.repartition("row", "piece")
    second = pinned(dealt.mapInArrow(_merged_pieces(a_path, b_path, piece_ends), _STITCH), "aligned-pieces")

    small = first.filter("n_a IS NOT NULL").select("row", "n_a", "n_b", "n_groups", "groups")
    done = small.unionByName(_stitched(second.filter("piece IS NOT NULL"), digest))
    blocks = first.filter("block IS NOT NULL").select("block", "rows", "sizes", "which", "pairs", "counts")
    blocks = blocks.unionByName(second.filter("block IS NOT NULL").select(*blocks.columns))

    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "one")).select(
        "block", "place", F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n")
    )
    totals = each.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = totals.groupBy("b_id").agg(F.max("total").alias("most"))
    links = pinned(totals.join(most, "b_id").select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "links")
    told = each.join(links, "pair").groupBy("block").agg(
        F.collect_list(F.struct("place", "total", F.col("best").cast("long").alias("best"))).alias("told")
    )
    judged = blocks.select("block", "rows", "sizes", "which").join(told, "block").select("rows", "sizes", "which", "told")
    sums = judged.mapInArrow(_judged, "row long, n_best long, count_sum long")
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    per_document = done.join(sums, "row", "left").select(
        F.col("row").alias("row_key"), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups",
    )
    corpus = links.select(
        F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"),
        F.col("total").alias("count"), "best",
    )
    return per_document, corpus
