"""Packing documents into sequences by swap-based local search.

Documents become pieces of at most ``capacity`` tokens; a full piece is a sequence of its
own. The rest is dealt at random into groups of bounded size. In a group pieces are placed
best-fit, largest first; then the least filled sequence is emptied into fuller ones by
moves, one-for-one and two-for-one exchanges. Each step takes tokens from a sequence to one
that ends up fuller than the first was, so the sum of squared fills only grows and the
search ends. The least filled sequences of all groups, at most half of each, are dealt again,
level by level, until one group is left, so the last open sequences of many groups come together.

Defined results: a null or empty text is its end token alone; every row is packed, also with
a null or repeated id; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, in_slices, keyed
from narrascope.llm.tokens import text_encoder

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 4096
#: Of each group, at most as many of its least filled sequences are dealt again at the next level,
#: and at most half of them, so that every level places pieces for good.
_REOPENED = 32
#: A search ends when so many of the least filled sequences in turn cannot be emptied.
_RESISTING = 16
#: Of a sequence's number, the bits for its group and for its place in the group.
_GROUP_BITS, _BIN_BITS = 36, 21


def _pieces(path: str, capacity: int, end_id: int):
    def make():
        encoder = text_encoder(path)
        end = np.array([end_id], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            ids_of_all, counts = encoder.encode(batch.column(1))
            edges = np.r_[0, np.cumsum(counts)].tolist()
            for row, a, b in zip(batch.column(0).to_pylist(), edges, edges[1:]):
                ids = memoryview(ids_of_all[a:b].tobytes() + end)
                total, start = len(ids) // 4, 0
                length = total % capacity or capacity
                for piece in range(-(-total // capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((row, piece, start, length, zlib.crc32(part)))
                    start, length = start + length, capacity
            columns = list(zip(*out)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
                ["row", "piece", "start", "length", "ids_crc32"],
            )

        return step

    return make


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """(row, piece, start, length, ids_crc32) of each document's ids with ``end_id`` appended.

    Only documents of more than ``capacity`` ids are cut; all their pieces but the first are full.
    """
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    schema = "row long, piece int, start long, length long, ids_crc32 long"
    return in_slices(texts, _pieces(tokenizer, capacity, end_id), schema, 1)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of ``sizes`` by bin: the largest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room for exactly r more
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[place]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            which = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[which].append(place)
        else:
            room, which = capacity, len(bins)
            bins.append([place])
        if room > size:
            by_room.setdefault(room - size, []).append(which)
            rooms |= 1 << (room - size)
    return bins


def fewest_bins(sizes: list[int], capacity: int) -> int:
    """A bound from below: large pieces cannot share a bin, smaller ones fill what those leave."""
    count = np.bincount(np.array(sizes, np.int64), minlength=capacity + 1)
    number, total = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * np.arange(count.size))]
    # number[s] and total[s]: pieces smaller than s, and the sum of their sizes.
    small = np.arange(1, capacity // 2 + 1)
    half = capacity // 2 + 1
    alone = number[-1] - number[capacity - small + 1]
    large = number[capacity - small + 1] - number[half]
    room = large * capacity - (total[capacity - small + 1] - total[half])
    rest = np.maximum(0, total[half] - total[small] - room)
    return int(max(np.max(alone + large - (-rest // capacity)), -(-total[-1] // capacity)))


class _Search:
    """Local search over the underfull bins of one group."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes = np.array(sizes, np.int64)
        self.capacity = capacity
        self.fill = np.array([sum(sizes[i] for i in b) for b in bins], np.int64)
        self.bin = np.full(len(sizes), -1, np.int64)
        for number, members in enumerate(bins):
            self.bin[members] = number
        # Only pieces in underfull bins can move.
        self.open = np.flatnonzero(self.fill[self.bin] < capacity)

    def move(self, place: int, to: int) -> None:
        self.fill[self.bin[place]] -= self.sizes[place]
        self.fill[to] += self.sizes[place]
        self.bin[place] = to

    def _target(self, least: int, most: int, home: int) -> int | None:
        """The piece outside ``home`` whose exchange for ``most`` tokens fills its bin the most.

        Its size is at least ``least`` and below ``most``, and its bin has room for the gain.
        """
        size, where = self.sizes[self.open], self.bin[self.open]
        gain = most - size
        fits = (size >= least) & (gain > 0) & (where != home) & (gain <= self.capacity - self.fill[where])
        fits &= self.fill[where] + gain > self.fill[home]
        if not fits.any():
            return None
        at = np.flatnonzero(fits)
        return int(self.open[at[np.argmax(gain[at])]])

    def step(self, home: int) -> bool:
        """Take tokens out of ``home``, as many as one move or exchange can."""
        mine = [int(i) for i in self.open if self.bin[i] == home]
        mine.sort(key=lambda i: -self.sizes[i])
        others = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        others = others[others != home]
        for place in mine:
            after = self.fill[others] + self.sizes[place]
            able = (after <= self.capacity) & (after > self.fill[home])
            if able.any():
                self.move(place, int(others[able][np.argmax(after[able])]))
                return True
        best, size = None, self.sizes[mine].tolist()
        # Of groups that give the same, the first stands for all.
        groups = {}
        for given, place in zip(size, mine):
            groups.setdefault(given, (place,))
        for n, a in enumerate(mine):
            for given, b in zip(size[n + 1 :], mine[n + 1 :]):
                groups.setdefault(size[n] + given, (a, b))
        for given, group in groups.items():
            target = self._target(1, given, home)
            if target is not None and (best is None or given - self.sizes[target] > best[0]):
                best = (given - self.sizes[target], group, target)
        if best:
            _, group, target = best
            there = int(self.bin[target])
            self.move(target, home)
            for place in group:
                self.move(place, there)
            return True
        return self._two_of_theirs(home, mine)

    def _two_of_theirs(self, home: int, mine: list[int]) -> bool:
        """Exchange one piece of ``home`` for two smaller ones of another bin."""
        firsts: dict[int, int] = {}  # of equal pieces one stands for all
        for place in mine:
            firsts.setdefault(int(self.sizes[place]), place)
        for there in np.unique(self.bin[self.open]):
            room = self.capacity - self.fill[there]
            if there == home or self.fill[there] == 0 or not room:
                continue
            theirs = sorted((int(i) for i in self.open[self.bin[self.open] == there]), key=lambda i: self.sizes[i])
            sizes = [int(self.sizes[i]) for i in theirs]
            for place in firsts.values():
                for i, size in enumerate(sizes):
                    # The second is the smallest that leaves no more gain than there is room.
                    j = max(i + 1, bisect_left(sizes, self.sizes[place] - size - room))
                    if j < len(sizes):
                        gain = self.sizes[place] - size - sizes[j]
                        if 0 < gain <= room and self.fill[there] + gain > self.fill[home]:
                            self.move(theirs[i], home)
                            self.move(theirs[j], home)
                            self.move(place, int(there))
                            return True
        return False

    def run(self) -> None:
        """Empty bins until as few are left as can be, or the emptiest ones resist."""
        least = fewest_bins(self.sizes.tolist(), self.capacity)
        stuck: set[int] = set()
        while np.count_nonzero(self.fill) > least and len(stuck) < _RESISTING:
            homes = [h for h in np.unique(self.bin[self.open]) if 0 < self.fill[h] < self.capacity and h not in stuck]
            if not homes:
                break
            home = min(homes, key=lambda h: self.fill[h])
            before = self.fill[home]
            while self.fill[home] and self.step(home):
                pass
            if self.fill[home] < before:
                stuck.clear()  # what was stuck may find room now
            if self.fill[home]:
                stuck.add(int(home))


def pack(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """Bin of each size, with as few bins as the search finds."""
    bins = best_fit(sizes, capacity)
    if not bins:
        return np.empty(0, np.int64)
    search = _Search(sizes, bins, capacity)
    search.run()
    return search.bin


def _pack_group(capacity: int):
    """A sequence, and how full it is, for each piece of a group."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("piece", "ascending")])
        sizes = table["length"].to_numpy()
        bins = pack(sizes.tolist(), capacity)
        if bins.size and bins.max() >= 1 << _BIN_BITS:
            raise ValueError("more sequences in a group than sequence numbers")
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        rank = np.empty(fill.size, np.int64)
        rank[np.argsort(fill, kind="stable")] = np.arange(fill.size)
        rank -= np.count_nonzero(fill == 0)  # emptied bins
        reopened = (rank < min(_REOPENED, np.count_nonzero(fill) // 2)) & (fill < capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        first = np.r_[True, np.diff(bins[order]) != 0]
        offsets = np.empty(sizes.size, np.int64)
        offsets[order] = ends - sizes[order] - np.repeat(
            (ends - sizes[order])[first], np.diff(np.r_[np.flatnonzero(first), first.size])
        )
        return pa.table({
            "row": table["row"], "piece": table["piece"], "length": table["length"],
            "grp": table["grp"], "bin": rank[bins], "offset": offsets, "reopened": reopened[bins],
        })

    return run


_PACKED = "row long, piece int, length long, grp long, bin long, offset long, reopened boolean"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(row, piece, sequence_id, offset) of pieces (row, piece, length)."""
    number = F.xxhash64("row", "piece")
    # Numbers below zero for sequences of one full piece, level, group and bin for the others.
    full = pieces.filter(F.col("length") == capacity).select(
        "row", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = pieces.filter(F.col("length") < capacity).select("row", "piece", "length")
    placed, level = full, 0
    while True:
        groups = max(1, -(-left.count() // group_pieces))
        if groups >= 1 << _GROUP_BITS or level >= 1 << 63 - _GROUP_BITS - _BIN_BITS:
            raise ValueError("more groups of pieces than sequence numbers")
        dealt = left.withColumn("grp", F.pmod(F.xxhash64(F.lit(level), number), F.lit(groups)))
        packed = pinned(dealt.groupBy("grp").applyInArrow(_pack_group(capacity), _PACKED), "packed")
        # The least filled sequences of each group come first and are opened again, unless full.
        again = F.col("reopened") if groups > 1 else F.lit(False)
        sequence = (F.lit(level << _GROUP_BITS) + F.col("grp")) * (1 << _BIN_BITS) + F.col("bin")
        placed = placed.unionByName(packed.filter(~again).select("row", "piece", sequence.alias("sequence_id"), "offset"))
        if groups == 1:
            break
        left, level = packed.filter(again).select("row", "piece", "length"), level + 1
    return placed


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: row_key, id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs, row = keyed(docs, id_col)
    pieces = pinned(token_pieces(docs, tokenizer, row, text_col, capacity, end_id), "pieces")
    placed = pack_pieces(pieces.select("row", "piece", "length"), capacity)
    ids = docs.select(col(row).cast("long").alias("row"), col(id_col).alias("id"))
    return pieces.join(placed, ["row", "piece"]).join(ids, "row").select(
        F.col("row").alias("row_key"), "id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
