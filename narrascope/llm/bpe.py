"""BPE encoding and decoding, long unsplit text by tree concatenation.

Words of ordinary length are encoded by the library, different ones once while a worker has
them in mind: ASCII white space separates words for good in tokenizers that drop white space,
whatever they normalise. A longer run without white space is normalised and split as the library
does it, and a piece that is still long is cut into leaves that are encoded in different
tasks. Level by level two neighbours are joined: a window around the join is encoded anew
and grows until it has a token in common with either side, same place and same number. A
sequence is the encoding of a text when each two adjacent tokens encode to themselves, and
every adjacent pair then comes from one of the three encodings, so the result is exact.

Defined results: null counts as empty, without tokens, decoded to the empty text; every row
has its own result, also with a null or repeated id; an empty table gives an empty result;
columns other than id and text are not looked at.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned, pinned_next
from narrascope.llm.common import SPACES, col, in_slices, keyed, lists_of, texts_of
from narrascope.llm.tokens import TextEncoder

#: A run without ASCII white space that is longer is taken apart.
LONG_CHARS = 1 << 12
LEAF_CHARS = 1 << 10
_WINDOW_TOKENS = 8


class WordEncoder(TextEncoder):
    """A tokenizer that drops white space, with what is needed to take long runs apart."""

    def __init__(self, path: str):
        super().__init__(path)
        told = json.loads(self.tokenizer.to_str())
        model, added = told["model"], told["added_tokens"]
        if (
            model["type"] != "BPE" or told["post_processor"] is not None or told["decoder"]
            or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
            or any(c in SPACES for t in added for c in t["content"])
            or self.tokenizer.encode(" a \n", add_special_tokens=False).ids
            != self.tokenizer.encode("a", add_special_tokens=False).ids
        ):
            raise ValueError("not a BPE tokenizer that drops white space")
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.cuttable = True
        self.mark, self.mark_id = min(((t["content"], t["id"]) for t in added), default=(None, None))
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # This tokenizer's decoder sets tokens apart by spaces.
        self.spaced = pa.array([f"{name} ".encode() for name in names], pa.large_binary())

    def _starts(self, data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Parts are words with the ASCII white space behind them."""
        white = (data == 32) | ((data >= 9) & (data <= 13))
        first = np.zeros(data.size, bool)
        first[1:] = ~white[1:] & white[:-1]
        first[text_starts[text_starts < data.size]] = True
        return np.flatnonzero(first)

    encode_texts = TextEncoder.encode

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids and decoded text of one text."""
        ids, counts = self.encode_texts(pa.array([text], pa.string()))
        return ids, self.decode(ids, counts)[0].decode()

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Decoded texts, as UTF-8, of ids that lie in a row."""
        joined = self.spaced.take(pa.array(ids))
        edges = np.frombuffer(joined.buffers()[1], np.int64)[np.r_[0, np.cumsum(counts)]].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [bytes(data[a : b - 1]) if b > a else b"" for a, b in zip(edges, edges[1:])]

    def pieces(self, run: str):
        """(ids, None) of what is ready and (None, piece) of long pieces, for a run in order."""
        for i, segment in enumerate(self.special.split(run) if self.special else [run]):
            if i % 2:
                yield [self.tokenizer.token_to_id(segment)], None
                continue
            normal = self.tokenizer.normalizer.normalize_str(segment) if self.tokenizer.normalizer else segment
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) if normal else []:
                if len(piece) > LONG_CHARS:
                    yield None, piece
                else:
                    yield self.piece(piece)[0].tolist(), None

    def piece(self, piece: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the tokens of one split piece and their lengths in bytes, as the library has them."""
        tokens = self.tokenizer.model.tokenize(piece)
        ends = [t.offsets[1] for t in tokens]
        starts = [t.offsets[0] for t in tokens]
        return np.array([t.id for t in tokens], np.int32), np.subtract(ends, starts).astype(np.int32)

    def joined(self, left: str, left_tokens, right: str, right_tokens):
        """Tokens (ids, lengths) of ``left + right`` from the tokens of either."""
        (ids, sizes), (more, widths) = left_tokens, right_tokens
        left, right = left.encode(), right.encode()
        size = _WINDOW_TOKENS
        while True:
            a, b = max(0, ids.size - size), min(more.size, size)
            start = len(left) - int(sizes[a:].sum())
            end = int(widths[:b].sum())
            new, lengths = self.piece((left[start:] + right[:end]).decode())
            ends = np.cumsum(lengths)
            place = len(left) - start  # of the join in the window
            head = _common(ids[a:], np.cumsum(sizes[a:]), new, ends, 0, place) if a else (0, 0)
            tail = (b, new.size)
            if b < more.size:
                tail = _common(more[:b], place + np.cumsum(widths[:b]), new, ends, place, place + end)
            if head and tail:
                keep, skip = head
                drop, stop = tail
                return (
                    np.concatenate([ids[: a + keep], new[skip:stop], more[drop:]]),
                    np.concatenate([sizes[: a + keep], lengths[skip:stop], widths[drop:]]),
                )
            size *= 2


def _common(ids, ends, new, new_ends, low: int, high: int):
    """Index past a token that both have inside (low, high), in the first and in the second.

    The token nearest to the window's edge would do; one that is a token away from the
    window's ends is taken, as those may see the cut.
    """
    starts = dict(zip(zip((new_ends - _widths(new_ends)).tolist(), new_ends.tolist(), new.tolist()), range(new.size)))
    begins = ends - _widths(ends, low)
    for i, token in enumerate(zip(begins.tolist(), ends.tolist(), ids.tolist())):
        at = starts.get(token)
        if at is not None and token[0] >= low and token[1] <= high and 0 < i < ids.size - 1 and 0 < at < new.size - 1:
            return (i + 1, at + 1)
    return None


def _widths(ends, first: int = 0):
    return np.diff(ends, prepend=first)


@cache
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, kept by a worker from task to task."""
    return WordEncoder(path)


def _has_long_run(text):
    """Few texts are long enough to look for such a run."""
    run = "[^ \\t\\n\\x0B\\f\\r]{%d}" % (LONG_CHARS + 1)
    return F.coalesce((F.length(text) > LONG_CHARS) & text.rlike(run), F.lit(False))


def _encoded(path: str):
    def make():
        encoder = word_encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, counts = encoder.encode_texts(batch.column(1))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), lists_of(ids.astype(np.int32), counts, pa.int32()),
                 pa.array(encoder.decode(ids, counts), pa.binary()).cast(pa.string())],
                ["row_key", "ids", "decoded"],
            )

        return step

    return make


_PART = "row long, part long, leaf long, leaves long, ids array<int>, piece string"


def _taken_apart(path: str):
    """Texts as numbered parts: ids that are ready, or one leaf of a long piece."""

    def make():
        encoder = word_encoder(path)

        def parts(text: str):
            ready: list[int] = []
            for run in text.encode().split():
                if len(run) <= LONG_CHARS:
                    ready += np.frombuffer(encoder.words.of([run])[0], "<u4").tolist()
                    continue
                for ids, piece in encoder.pieces(run.decode()):
                    if piece is None:
                        ready += ids
                        continue
                    yield ready, None
                    ready = []
                    yield None, piece
            yield ready, None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                for number, (ids, piece) in enumerate(parts(text)):
                    if piece is None:
                        out.append((row, number, 0, 0, ids, None))
                        continue
                    leaves = -(-len(piece) // LEAF_CHARS)
                    for i in range(leaves):
                        out.append((row, number, i, leaves, None, piece[i * LEAF_CHARS : (i + 1) * LEAF_CHARS]))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.string()]
            columns = list(zip(*out)) or [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "part", "leaf", "leaves", "ids", "piece"]
            )

        return step

    return make


_NODE = "row long, part long, node long, nodes long, piece string, ids array<int>, sizes array<int>"
_NODE_NAMES = ["row", "part", "node", "nodes", "piece", "ids", "sizes"]


def _nodes(head, pieces, tokens) -> pa.RecordBatch:
    ids = lists_of(np.concatenate([np.empty(0, np.int32), *[t[0] for t in tokens]]), [t[0].size for t in tokens], pa.int32())
    sizes = lists_of(np.concatenate([np.empty(0, np.int32), *[t[1] for t in tokens]]), [t[0].size for t in tokens], pa.int32())
    return pa.RecordBatch.from_arrays([*head, pa.array(pieces, pa.string()), ids, sizes], _NODE_NAMES)


def _leaves(path: str):
    def make():
        encoder = word_encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pieces = batch.column(4).to_pylist()
            return _nodes(batch.columns[:4], pieces, [encoder.piece(p) for p in pieces])

        return step

    return make


def _pairs(path: str):
    def make():
        encoder = word_encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pieces, tokens = [], []
            for both in batch.column(5).to_pylist():
                piece, ids, sizes = both[0]["piece"], np.array(both[0]["ids"], np.int32), np.array(both[0]["sizes"], np.int32)
                if len(both) == 2:
                    right = np.array(both[1]["ids"], np.int32), np.array(both[1]["sizes"], np.int32)
                    ids, sizes = encoder.joined(piece, (ids, sizes), both[1]["piece"], right)
                    piece += both[1]["piece"]
                pieces.append(piece)
                tokens.append((ids, sizes))
            return _nodes(batch.columns[:4], pieces, tokens)

        return step

    return make


def _decoded(path: str):
    def make():
        tokenizer = word_encoder(path).tokenizer

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(1).to_pylist()
            texts = [tokenizer.decode(i, skip_special_tokens=False) for i in ids]
            return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["row_key", "ids", "decoded"])

        return step

    return make


def _concatenated(texts: DataFrame, path: str) -> DataFrame:
    parts = pinned(in_slices(texts, _taken_apart(path), _PART, 1), "parts")
    leaves = parts.filter("leaves > 0").select("row", "part", F.col("leaf").alias("node"), F.col("leaves").alias("nodes"), "piece")
    leaves = leaves.repartition("row", "part", "node")
    level, place = pinned_next(in_slices(leaves, _leaves(path), _NODE, 4), "tree")
    height = level.agg(F.max("nodes")).head()[0] or 1
    while height > 1:
        node = F.struct("node", "piece", "ids", "sizes")
        up = level.groupBy("row", "part", F.floor(F.col("node") / 2).alias("up"), "nodes").agg(
            F.sort_array(F.collect_list(node)).alias("both")  # two at most
        )
        up = up.select("row", "part", F.col("up").alias("node"), F.ceil(F.col("nodes") / 2).alias("nodes"),
                       F.col("both")[0]["piece"].alias("piece"), "both")
        level, place = pinned_next(in_slices(up, _pairs(path), _NODE, 4), "tree", place)
        height = -(-height // 2)
    done = parts.filter("leaves = 0").select("row", "part", "ids").unionByName(level.select("row", "part", "ids"))
    whole = done.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("all"))
    ids = whole.select(F.col("row").alias("row_key"), F.flatten("all.ids").alias("ids"))
    return ids.mapInArrow(_stepped(_decoded(path)), "row_key long, ids array<int>, decoded string")


def _stepped(make):
    def run(batches):
        step = make()
        yield from map(step, batches)

    return run


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row_key (its id where ids are unique), ids, decoded.

    ``tokenizer`` is the path, on every executor, of a tokenizers file with a BPE model that
    drops white space. ``ids`` are those of the library without added special tokens,
    ``decoded`` its decoding with special tokens kept.
    """
    WordEncoder(tokenizer)  # a tokenizer of another kind is refused here
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    plain = in_slices(texts.filter(~_has_long_run(F.col("text"))), _encoded(tokenizer),
                      "row_key long, ids array<int>, decoded string", 1)
    return plain.unionByName(_concatenated(texts.filter(_has_long_run(F.col("text"))), tokenizer))
