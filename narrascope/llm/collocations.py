"""Phrase collocations by Misra-Gries summaries and an exact second count.

Texts become blocks of numbered words, written once. Each block counts its phrases of one to
four words by a hash, which names one of many hash partitions and a key inside it. A hash
partition adds the counts of its blocks in a Misra-Gries summary with more counters than its
mass (all counts together) over the threshold; where counters run out, the least count that has
to go is taken off all of them. Summaries taken so can be merged in any order, and no count is
too small by more than mass / counters, which is less than the threshold. So every frequent
phrase survives. What survives goes back to the blocks that hold it, and those count it by its
words, which removes phrases that only share a hash.

A phrase is at most once in a block's counts, so a very common one is no load for one task, and
the number of hash partitions grows with the texts, so each has bounded mass and counters.

Defined results: a null text counts as empty, a null language as ``und``; every row counts,
repeated ones and those with equal or null ids too; an empty table, or one without frequent
phrases, gives an empty result; columns other than language and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, slices

MOST_WORDS = 4
THRESHOLD = 30
TOP = 2000
#: A phrase is left out if a longer candidate around it has so many hundredths of its count.
ABSORBED = 80
#: Bytes of text in a block, and the most that the phrases of a hash partition may count.
BLOCK_BYTES = 1 << 22
PARTITION_MASS = 1 << 23
#: Counters of a summary, as a multiple of mass over threshold. Beyond one, fewer phrases that
#: are not frequent survive.
COUNTERS = 4
_TOP_PARTS = 16

_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_KIND = np.zeros(256, np.uint8)  # of a byte: in a word, between words, between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2

#: Words, their languages' numbers, the text as their numbers and what follows what are packed.
_BLOCK = ("block long, langs array<string>, lang_words array<long>, kinds int, size int, "
          "words binary, word_langs binary, ids binary, follows binary")


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32, packed with their first bytes together, their second bytes and so on."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _numbers(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view("<u4").ravel()


def _segments(text: bytes, most: int) -> Iterator[bytes]:
    """A long text in parts that end behind a separator, which no phrase crosses."""
    data, at = np.frombuffer(text, np.uint8), 0
    while len(text) - at > most:
        ends = np.flatnonzero(_KIND[data[at : at + most]] == 2)
        if not ends.size:
            rest = np.flatnonzero(_KIND[data[at + most :]] == 2)
            if not rest.size:
                break
            end = at + most + int(rest[0]) + 1
        else:
            end = at + int(ends[-1]) + 1
        yield text[at:end]
        at = end
    yield text[at:]


def _block(texts: pa.Array, langs: pa.Array) -> dict | None:
    """Words of texts as numbers of (language, word), and whether each follows the one before
    it in the same piece."""
    texts = texts.cast(pa.large_binary())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(edges[-1] - edges[0])
    if not size:
        return None
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]]]
    edges = edges - edges[0]
    kind = _KIND[data]
    word, breaks = kind == 0, kind == 2
    begins = edges[:-1][edges[:-1] < size]
    breaks[begins] = True
    first, last = np.ones(size, bool), np.ones(size, bool)
    first[1:] = ~word[:-1]
    first[begins] = True
    last[:-1] = ~word[1:]
    last[begins[begins > 0] - 1] = True
    starts = np.flatnonzero(word & first)
    if not starts.size:
        return None
    lengths = np.flatnonzero(word & last) + 1 - starts
    piece = np.cumsum(breaks, dtype=np.int32)[starts]
    follows = np.zeros(starts.size, bool)
    follows[1:] = piece[1:] == piece[:-1]

    places = np.zeros(starts.size + 1, np.int32)
    np.cumsum(lengths, out=places[1:])
    parts = [None, pa.py_buffer(places), pa.py_buffer(data[word])]
    words = pa.Array.from_buffers(pa.binary(), starts.size, parts).dictionary_encode()
    names = pc.fill_null(langs, "und").dictionary_encode()
    of_doc = names.indices.to_numpy()
    lang = of_doc[np.searchsorted(edges, starts, "right") - 1].astype(np.int64)
    kinds, ids = np.unique(lang * len(words.dictionary) + words.indices.to_numpy(), return_inverse=True)
    word_langs, which = np.divmod(kinds, len(words.dictionary))
    return {
        "langs": names.dictionary.to_pylist(),
        "lang_words": np.bincount(lang, minlength=len(names.dictionary)).tolist(),
        "kinds": kinds.size,
        "size": ids.size,
        # No word has a line break.
        "words": zlib.compress(b"\n".join(words.dictionary.take(pa.array(which)).to_pylist()), 1),
        "word_langs": _planes(word_langs),
        "ids": _planes(ids),
        "follows": np.packbits(follows).tobytes(),
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) as blocks; a block's number is kept by the table that is written."""
    number = TaskContext.get().partitionId() << 32

    def parts():
        for batch in batches:
            for part in slices(batch, 1, BLOCK_BYTES):
                texts = pc.fill_null(part.column(1), "")
                if part.num_rows > 1:
                    yield texts, part.column(0)
                    continue
                for segment in _segments(texts[0].as_py().encode(), BLOCK_BYTES):
                    yield pa.array([segment], pa.binary()), part.column(0)

    for texts, langs in parts():
        found = _block(texts, langs)
        if found is not None:
            kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), *[pa.array([v], k) for v, k in zip(found.values(), kinds)]], ["block", *found]
            )
            number += 1


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Phrases:
    """The phrases of one block: where they begin, by number of words, and their places.

    A place is a hash partition in the upper and a key in the lower 32 bits.
    """

    def __init__(self, row: dict, partitions: int):
        self.ids = _numbers(row["ids"], row["size"]).astype(np.int32)
        self.words = zlib.decompress(row["words"]).split(b"\n")
        self.word_langs = _numbers(row["word_langs"], row["kinds"]).astype(np.int32)
        self.follows = np.unpackbits(np.frombuffer(row["follows"], np.uint8))[: self.ids.size].astype(bool)
        self.partitions = np.uint64(partitions)
        seeds = [xxhash.xxh64_intdigest(lang.encode()) for lang in row["langs"]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(word, seeds[lang]) for word, lang in zip(self.words, self.word_langs.tolist())]
        self.hashes = np.array(hashes, np.uint64)[self.ids]

    def by_size(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, beginnings, places) for phrases of one word, of two and so on."""
        at, so_far = np.arange(self.ids.size), self.hashes
        for size in range(1, MOST_WORDS + 1):
            if size > 1:
                stays = at + size - 1 < self.ids.size
                at, so_far = at[stays], so_far[stays]
                stays = self.follows[at + size - 1]
                at = at[stays]
                so_far = _mixed(so_far[stays], self.hashes[at + size - 1])
            part = (so_far >> np.uint64(32)) % self.partitions
            yield size, at, (part << np.uint64(32)) | (so_far & np.uint64(0xFFFFFFFF))


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, those of small difference to the one before in little room."""
    return _planes(np.diff(values, prepend=values.dtype.type(0)))


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(_numbers(packed, size), dtype=np.uint32)


_COUNTS = "part int, block long, size int, mass long, keys binary, counts binary"
_COUNT_NAMES = ["part", "block", "size", "mass", "keys", "counts"]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, as each may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _counts(partitions: int):
    """Of each block its count of each phrase, one row per hash partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            places = np.concatenate([p for _, _, p in _Phrases(row, partitions).by_size()])
            places, counts = np.unique(places, return_counts=True)
            parts = (places >> np.uint64(32)).astype(np.int32)
            starts = np.flatnonzero(np.diff(parts, prepend=np.int32(-1)))
            keys = places.astype(np.uint32)
            out = []
            for a, b in zip(starts, [*starts[1:], places.size]):
                found = counts[a:b].astype(np.uint32)
                out.append((int(parts[a]), row["block"], int(b - a), int(counts[a:b].sum()), _packed(keys[a:b]), _packed(found)))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], _COUNT_NAMES)

    return run


class MisraGries:
    """Counts of keys that are too small by at most ``off``, in at most ``counters`` counters."""

    def __init__(self, counters: int):
        self.counters, self.off = counters, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Another summary with as many counters, or exact counts, of different keys."""
        if keys.size:
            self._waiting.append((keys, counts.astype(np.int64)))
        if sum(k.size for k, _ in self._waiting) >= max(self.counters, 1 << 20):
            self.merge()

    def merge(self) -> None:
        if not self._waiting:
            return
        keys = np.concatenate([self.keys, *[k for k, _ in self._waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self._waiting]])
        self._waiting = []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if keys.size > self.counters:
            at = keys.size - self.counters - 1
            less = int(np.partition(counts, at)[at])
            self.off += less
            counts -= less
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """Keys, sorted, whose true count may be ``threshold`` or more: all that have it."""
        self.merge()
        return self.keys[self.counts + self.off >= threshold]


_SURVIVED = "block long, part int, size int, keys binary"


def _survivors(threshold: int):
    """Keys that may be frequent, given back to each block that has them.

    Rows come by hash partition. Those of one are held packed, which its mass bounds.
    """

    def close(part: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(COUNTERS * sum(r[2] for r in rows) // threshold + 1)
        for _, size, _, keys, counts in rows:
            summary.add(_unpacked(keys, size), _unpacked(counts, size))
        frequent, out = summary.at_least(threshold), []
        for block, size, _, keys, _ in rows:
            both = np.intersect1d(frequent, _unpacked(keys, size), assume_unique=True)
            if both.size:
                out.append((block, part, both.size, _packed(both)))
        if out:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["block", "part", "size", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for row in _rows_of(batches):
            if row["part"] != part:
                if rows:
                    yield from close(part, rows)
                part, rows = row["part"], []
            rows.append((row["block"], row["size"], row["mass"], row["keys"], row["counts"]))
        if rows:
            yield from close(part, rows)

    return run


_PHRASES = "part int, langs array<string>, size int, of_lang binary, phrases binary, counts binary"


def _exactly(partitions: int):
    """Counts in each block of the phrases that survived, by their words, one row per hash
    partition, sorted and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            kept = [np.uint64(s["part"] << 32) | _unpacked(s["keys"], s["size"]).astype(np.uint64) for s in row["survived"]]
            kept = np.sort(np.concatenate(kept))
            phrases, found = _Phrases(row, partitions), []
            words = pa.array(phrases.words, pa.binary())
            for size, at, places in phrases.by_size():
                where = np.minimum(np.searchsorted(kept, places), kept.size - 1)
                stays = kept[where] == places
                at, places = at[stays], places[stays]
                if not at.size:
                    continue
                columns = [phrases.ids[at + j].astype(np.int64) for j in range(size)]
                code = columns[0]
                for column in columns[1:]:
                    _, code = np.unique(code * len(words) + column, return_inverse=True)
                _, one, counts = np.unique(code, return_index=True, return_counts=True)
                texts = pc.binary_join_element_wise(*[words.take(pa.array(c[one])) for c in columns], b" ")
                parts = (places[one] >> np.uint64(32)).astype(np.int32)
                found.append(pa.table([parts, texts, phrases.word_langs[columns[0][one]], counts], ["part", "phrase", "lang", "count"]))
            table = pa.concat_tables(found).sort_by([("part", "ascending"), ("phrase", "ascending")]).combine_chunks()
            parts, texts, langs, counts = (table.column(c).combine_chunks() for c in range(4))
            parts, langs, counts = (c.to_numpy() for c in (parts, langs, counts))
            starts = np.flatnonzero(np.diff(parts, prepend=np.int32(-1)))
            out = []
            for a, b in zip(starts, [*starts[1:], parts.size]):
                lines = zlib.compress(b"\n".join(texts[a:b].to_pylist()), 1)
                out.append((int(parts[a]), row["langs"], int(b - a), _planes(langs[a:b]), lines, _planes(counts[a:b])))
            kinds = [pa.int32(), pa.list_(pa.string()), pa.int32(), *[pa.binary()] * 3]
            names = ["part", "langs", "size", "of_lang", "phrases", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def _added(tables: list[pa.Table]) -> list[pa.Table]:
    """Counts of equal phrases of a language in one."""
    whole = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("count", "sum")])
    return [whole.rename_columns({"count_sum": "count"}).select(["lang", "phrase", "count"])]


def _summed(threshold: int):
    """Frequent phrases with their count in all blocks. Rows come by hash partition."""

    def close(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        found = _added(tables)[0]
        found = found.filter(pc.greater_equal(found["count"], threshold))
        phrases = found["phrase"].cast(pa.string())
        sizes = pc.add(pc.count_substring(phrases, " "), 1).cast(pa.int32())
        out = pa.table([found["lang"], sizes, phrases, found["count"]], ["lang", "size", "phrase", "count"])
        yield from out.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tables = None, []
        for row in _rows_of(batches):
            if row["part"] != part:
                if tables:
                    yield from close(tables)
                part, tables = row["part"], []
            langs = pa.array(row["langs"], pa.string()).take(pa.array(_numbers(row["of_lang"], row["size"])))
            phrases = pa.array(zlib.decompress(row["phrases"]).split(b"\n"), pa.binary())
            counts = pa.array(_numbers(row["counts"], row["size"]).astype(np.int64))
            tables.append(pa.table([langs, phrases, counts], ["lang", "phrase", "count"]))
            if sum(t.num_rows for t in tables[1:]) > max(1 << 18, tables[0].num_rows):
                tables = _added(tables)
        if tables:
            yield from close(tables)

    return run


def frequent_phrases(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", threshold: int = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, count) of phrases of one to four words that occur ``threshold``
    times in a language, and (lang, n), the words of each language."""
    texts = docs.select(col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"))
    blocks = pinned(texts.mapInArrow(_blocks, _BLOCK), "word-blocks")
    each = blocks.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("one"))
    totals = each.groupBy(F.col("one.langs").alias("lang")).agg(F.sum("one.lang_words").alias("n"))
    # A phrase of each length begins with a word at most.
    words = blocks.agg(F.sum("size")).head()[0] or 0
    partitions = int(MOST_WORDS * words / PARTITION_MASS) + 1

    wide = blocks.drop("lang_words")
    counts = wide.mapInArrow(_counts(partitions), _COUNTS)
    by_part = counts.repartition(partitions, "part").sortWithinPartitions("part")
    survived = by_part.mapInArrow(_survivors(threshold), _SURVIVED)
    back = survived.groupBy("block").agg(F.collect_list(F.struct("part", "size", "keys")).alias("survived"))
    again = wide.join(back, "block").mapInArrow(_exactly(partitions), _PHRASES)
    again = again.repartition(partitions, "part").sortWithinPartitions("part")
    exact = again.mapInArrow(_summed(threshold), "lang string, size int, phrase string, count long")
    return pinned(exact, "frequent-phrases"), totals


def _part_of(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language.

    ``a`` is the count of the phrase, ``l`` and ``r`` those of the parts of its weakest cut and
    ``score`` is 2,000,000 a / (l + r), rounded down; phrases that mostly occur inside one
    longer candidate are left out. ``n`` is the number of words of the language.
    """
    frequent, totals = frequent_phrases(docs, lang_col, text_col, threshold)
    words = F.split("phrase", " ", -1)
    candidates = frequent.filter("size > 1").select("lang", "size", "phrase", F.col("count").alias("a"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        _part_of(words, F.lit(1), F.col("k")).alias("left"),
        _part_of(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    lefts = frequent.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l"))
    rights = frequent.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r"))
    score = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) DIV (CAST(l AS DECIMAL(19, 0)) + r)")
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: _part_of(words, i, m)),
    ))
    longer = candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    absorbed = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * ABSORBED
    stay = weakest.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(absorbed, F.lit(False)))

    # The best of each of some parts first, so that one task meets few for each language.
    order = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_TOP_PARTS))).orderBy(*order)
    best = stay.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
    )
