"""Reading quoted CSV files of any size with all cores, in one pass over their text.

A line break inside quotes does not end a record, so a reader that starts in the middle of a
file cannot tell where the next record begins. A block of a file starts either with a record or
inside quotes, and which of the two follows from the blocks before it:

1. each block is cut into records as if one began with its first line. The same pass follows the
   other case until both agree on where a record begins, which they soon do from the first
   quote on; all records behind that place are the same. One small row tells about each block;
2. the true start of every block follows by a window over those small rows;
3. only where a record goes on across a border are the lines around that border, up to the place
   where both cases agree, put together and cut into records again.

Exports have broken quotes. A record is whole if every quote that opens a field is closed in
front of a comma or the end of a line, and it has as many fields as the header. Another line is
a corrupt record of its own; if it opens a quote, it takes the lines behind it along up to the
next one where a whole record begins, or that has as many commas as the header. So a stray quote
costs its own record, and the rows do not depend on where blocks begin.

Fields are parsed by Spark's own ``from_csv``. Inside tasks lines that are whole records, nearly
all, are found as columns; the others are looked at one by one.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned, small_side

_FIELD = r'(?:"(?:[^"]|"")*"|[^",][^,]*|)'
_INSIDE = re.compile(r'(?:[^"]++|"")*+')
#: A record's fate as far as the lines go: whole, not one, or not known without more lines.
_WHOLE, _BROKEN, _OPEN = range(3)
#: States of a block are a few numbers; so many blocks are sent to every executor.
_FEW_BLOCKS = 1 << 17


class _Lines:
    """Lines in a row, and how records lie in them."""

    def __init__(self, texts: pa.Array, fields: int):
        self.texts, self.fields = texts, fields
        quoted = pc.match_substring(texts, '"')
        commas = pc.equal(pc.count_substring(texts, ","), fields - 1).to_numpy(zero_copy_only=False)
        self.quoted = np.flatnonzero(quoted.to_numpy(zero_copy_only=False))
        self.alone = commas.copy()  # a whole record in one line
        if self.quoted.size:
            more = f"(?:{_FIELD},){{{fields - 1}}}" if fields > 1 else ""
            fit = pc.match_substring_regex(texts.take(pa.array(self.quoted)), rf"(?s)^{more}{_FIELD}\r?$")
            self.alone[self.quoted] = fit.to_numpy(zero_copy_only=False)
        blank = pc.or_(pc.equal(texts, ""), pc.equal(texts, "\r")).to_numpy(zero_copy_only=False)
        self.alone &= ~blank
        self.shaped = commas & ~blank  # with the header's number of commas
        self.others = np.flatnonzero(~self.alone)
        self.blank = set(np.flatnonzero(blank).tolist())

    def __len__(self) -> int:
        return len(self.texts)

    def line(self, at: int) -> str:
        return self.texts[at].as_py()

    def _rest(self, text: str, place: int, at: int, counted: int) -> tuple[int, int]:
        """(fate, last line) of a record whose next field begins at ``place``; ``counted`` of its
        fields are behind, below zero if that is not known."""
        count = counted
        while True:
            if not text.startswith('"', place):
                comma = text.find(",", place)
                count += 1
                if comma >= 0:
                    place = comma + 1
                    continue
                break
            place += 1
            while (end := _INSIDE.match(text, place).end()) == len(text):
                if (at := self.next_quoted(at)) is None:
                    return _OPEN, len(self) - 1
                text, place = self.line(at), 0
            count += 1
            if end + 1 == len(text) or text[end + 1 :] == "\r":
                break
            if text[end + 1] != ",":
                return _BROKEN, at
            place = end + 2
        return (_WHOLE if counted < 0 or count == self.fields else _BROKEN), at

    def next_quoted(self, at: int) -> int | None:
        """The first line behind ``at`` with a quote."""
        place = int(np.searchsorted(self.quoted, at, "right"))
        return int(self.quoted[place]) if place < self.quoted.size else None

    def inside(self) -> tuple[int, int]:
        """(fate, last line) of a record that the first line lies inside a quoted field of."""
        at = -1
        while (at := self.next_quoted(at)) is not None:
            text = self.line(at)
            end = _INSIDE.match(text, 0).end()
            if end == len(text):
                continue
            if end + 1 == len(text) or text[end + 1 :] == "\r":
                return _WHOLE, at
            return self._rest(text, end + 2, at, -(1 << 40)) if text[end + 1] == "," else (_BROKEN, at)
        return _OPEN, len(self) - 1

    def record(self, at: int) -> tuple[int, int]:
        """(fate, last line) of a record that begins with a line."""
        if self.alone[at]:
            return _WHOLE, at
        return self._rest(self.line(at), 0, at, 0)

    def after(self, at: int) -> tuple[int, int]:
        """(fate, next beginning) of what begins at a line; a broken record ends there too."""
        if at in self.blank:
            return _WHOLE, at + 1
        fate, end = self.record(at)
        if fate == _WHOLE:
            return _WHOLE, end + 1
        if fate == _BROKEN and end == at and not self._opens(at):
            return _BROKEN, at + 1
        if fate == _OPEN:
            return _OPEN, len(self)
        return self.resumed(at)

    def _opens(self, at: int) -> bool:
        """Whether a line has a quote where a field begins."""
        text = self.line(at)
        return text.startswith('"') or ',"' in text

    def resumed(self, at: int) -> tuple[int, int]:
        """Where the next record begins behind a line whose quotes are broken."""
        for there in range(at + 1, len(self)):
            fate = self.begins(there)
            if fate != _BROKEN:
                return (_BROKEN, there) if fate == _WHOLE else (_OPEN, len(self))
        return _OPEN, len(self)

    def begins(self, at: int) -> int:
        """Whether a record begins with a line, for one whose own quotes are broken to end there."""
        if self.alone[at] or self.shaped[at]:
            return _WHOLE
        return _BROKEN if at in self.blank else self.record(at)[0]

    def joined(self, start: int, end: int) -> str:
        return "\n".join(self.texts[start:end].to_pylist())


def _cut(lines: _Lines, at_end: bool) -> tuple[list[int], list[bool], int]:
    """Beginnings of records from the first line on, which are broken, and where what is not
    known yet begins. With ``at_end`` nothing follows, and an open quote is a broken one."""
    starts, broken, at, total = [], [], 0, len(lines)
    others = lines.others
    while at < total:
        place = int(np.searchsorted(others, at))
        until = int(others[place]) if place < others.size else total
        starts.extend(range(at, until))
        broken.extend([False] * (until - at))
        at = until
        if at == total:
            break
        fate, end = lines.after(at)
        if fate == _OPEN and not at_end:
            return starts, broken, at
        if fate == _OPEN:
            # Nothing closes it with what is there.
            end = next((i for i in range(at + 1, total) if lines.begins(i) == _WHOLE), total)
        starts.append(at)
        broken.append(fate != _WHOLE)
        at = end
    return starts, broken, total


_ROW = "text string, broken boolean, file long, block long, n int, open boolean"
_TOLD = "quotes boolean, common int, first_sure int, is_open boolean"
_CUT = f"{_ROW}, {_TOLD}"
_KINDS = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.bool_()]
_NAMES = [field.split()[0] for field in _CUT.split(", ")]


class _Block:
    """One block, cut as its lines come."""

    def __init__(self, key: tuple[int, int], fields: int):
        self.key, self.fields = key, fields
        self.waiting = pa.array([], pa.string())  # lines of what is not known yet
        self.n = self.seen = 0  # records given, and lines read
        self.quotes = False
        # The first record that ends any broken one before it, and the first such in both cases.
        self.first_sure: int | None = None
        self.common: int | None = None
        # To follow the other case: lines from the first with a quote on, and the line number
        # and record number of what begins there in the first case.
        self.held: list[pa.Array] = []
        self.held_from = 0
        self.begun: dict[int, int] = {}

    def add(self, texts: pa.Array) -> pa.RecordBatch | None:
        if self.common is None:
            self._hold(texts)
        self.seen += len(texts)
        whole = pa.concat_arrays([self.waiting, texts]) if len(self.waiting) else texts
        first = self.seen - len(whole)
        lines = _Lines(whole, self.fields)
        starts, broken, end = _cut(lines, False)
        out = self._rows(lines, starts, broken, end, first)
        self.waiting = whole[end:]
        if self.common is None and self.held:
            self._follow()
        return out

    def _hold(self, texts: pa.Array) -> None:
        if not self.held:
            quoted = pc.match_substring(texts, '"')
            at = pc.index(quoted, True).as_py()
            if at < 0:
                return
            self.quotes, self.held_from = True, self.seen + at
            texts = texts[at:]
        self.held.append(texts)

    def _rows(self, lines, starts, broken, end, first) -> pa.RecordBatch | None:
        if not starts:
            return None
        if self.common is None:
            sure = [i for i, (at, bad) in enumerate(zip(starts, broken)) if lines.shaped[at] or not (bad or at in lines.blank)]
            if sure and self.first_sure is None:
                self.first_sure = self.n + sure[0]
            if self.held:
                self.begun.update((first + starts[i], self.n + i) for i in sure if first + starts[i] >= self.held_from)
        offsets = pa.array([*starts, end], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.texts), "\n")
        out = self._batch(texts, broken, False)
        self.n += len(starts)
        return out

    def _batch(self, texts, broken, is_open: bool, told=(None,) * 4) -> pa.RecordBatch:
        size, (file, block) = len(broken), self.key
        numbers = np.arange(self.n, self.n + size, dtype=np.int32)
        columns = [texts, broken, [file] * size, [block] * size, numbers, [is_open] * size, *([value] * size for value in told)]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)

    def _follow(self) -> None:
        """Follow the case that the block starts inside quotes, until such a record begins where
        one does in the first case."""
        self.held = [pa.concat_arrays(self.held)]
        lines = _Lines(self.held[0], self.fields)
        fate, end = lines.inside()
        found = None
        if fate == _BROKEN:  # no field ends so: what was open is broken off by the first sure record
            found = self.first_sure
        at = end + 1 if fate == _WHOLE else len(lines)
        while found is None and at < len(lines) and fate != _OPEN:
            found = self.begun.get(at + self.held_from)
            fate, at = lines.after(at)
        if found is not None:
            self.common, self.held, self.begun = found, [], {}

    def close(self) -> Iterator[pa.RecordBatch]:
        is_open = len(self.waiting) > 0
        if is_open:
            yield self._batch(["\n".join(self.waiting.to_pylist())], [False], True)
        yield self._batch([None], [None], False, (self.quotes, self.common, self.first_sure, is_open))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows of one block; a task may read several blocks, one after the other."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
        change = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        edges = np.concatenate([[0], change, [len(file)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield (int(file[a]), int(block[a])), batch.slice(a, b - a)


def _cut_blocks(fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for key, batch in _segments(batches):
            if now is None or now.key != key:
                if now is not None:
                    yield from now.close()
                now = _Block(key, fields)
            out = now.add(batch.column("value"))
            if out is not None:
                yield out
        if now is not None:
            yield from now.close()

    return run


def _resolved(told: DataFrame) -> DataFrame:
    """Whether a record goes on from before into each block, from which block, and up to which
    of its records.

    A block whose cases agree ends in the same state whatever its start. Another one hands on an
    open record, and has none of its own or is open too. A quote that no other one follows in the
    file is broken, so what it opened ends at the next whole record.
    """
    order = Window.partitionBy("file").orderBy("block")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    to_end = order.rowsBetween(0, Window.unboundedFollowing)
    last_quote = ~F.max("quotes").over(to_end)
    states = told.withColumn("common", F.coalesce("common", F.when(last_quote, F.col("first_sure"))))
    decides = F.when(F.col("is_open") | F.col("common").isNotNull(), F.col("is_open"))
    states = states.withColumn("inside", F.coalesce(F.last(decides, ignorenulls=True).over(so_far), F.lit(False)))
    begins = F.when(F.col("is_open") & (~F.col("inside") | F.col("common").isNotNull()), F.col("block"))
    states = states.withColumn("opened", F.last(begins, ignorenulls=True).over(so_far))
    return states.select("file", "block", "inside", "common", "opened")


def _cut_borders(fields: int):
    """Records in the lines around each border, put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = _Lines(pa.array(whole.split("\n"), pa.string()), fields)
                starts, broken, _ = _cut(lines, True)
                texts = [lines.joined(a, b) for a, b in zip(starts, [*starts[1:], len(lines)])]
                heads = [head and i == 0 for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), pa.array(broken, pa.bool_()), pa.array(heads, pa.bool_())], ["text", "broken", "head"]
                )

    return run


def _without_headers(names: list[str]):
    """Records without those that begin a file, which have to be ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column(2)
            for text in batch.column(0).filter(heads).to_pylist():
                found = next(csv.reader([text.removesuffix("\r")]), []) if "\n" not in text else next(csv.reader(text.splitlines(True)), [])
                if found != names:
                    raise ValueError(f"a file begins with the columns {found}, not {names}")
            yield batch.filter(pc.invert(heads)).select(["text", "broken"])

    return run


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines in file order within each block, with the block they lie in."""
    return located(spark.read.option("lineSep", "\n").text(path))


def located(lines: DataFrame) -> DataFrame:
    """Lines read by the text source, with the file and the block that they lie in."""
    return lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _unix_breaks(record: Column) -> Column:
    """Without the carriage returns of a file that ends its lines with them."""
    plain = F.regexp_replace(F.replace(record, F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return F.when(F.endswith(record, F.lit("\r")), plain).otherwise(record)


def csv_records(lines: DataFrame, names: list[str]) -> DataFrame:
    """One row per CSV record, (record, broken), without headers, which must be ``names``."""
    cut = pinned(lines.mapInArrow(_cut_blocks(len(names)), _CUT), "csv-records")
    told = cut.where("text IS NULL").select("file", "block", "quotes", "common", "first_sure", "is_open")
    states = small_side(_resolved(told), _FEW_BLOCKS)
    rows = cut.where("text IS NOT NULL").select("text", "broken", "file", "block", "n", "open").join(states, ["file", "block"])
    before = F.col("inside") & (F.col("common").isNull() | (F.col("n") < F.col("common")))
    home = F.when(before, F.col("opened")).when(F.col("open"), F.col("block"))
    rows = rows.withColumn("home", home).withColumn("head", (F.col("block") == 0) & (F.col("n") == 0))
    around = rows.where("home IS NOT NULL").groupBy("file", "home").agg(
        F.array_sort(F.collect_list(F.struct("block", "n", "text"))).alias("parts"), F.max("head").alias("head")
    )
    whole = around.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), "head")
    across = whole.mapInArrow(_cut_borders(len(names)), "text string, broken boolean, head boolean")
    inside = rows.where("home IS NULL").select("text", "broken", "head")
    heads = inside.where("head").unionByName(across).mapInArrow(_without_headers(names), "text string, broken boolean")
    records = inside.where("NOT head").select("text", "broken").unionByName(heads)
    record = _unix_breaks(F.col("text"))
    return records.where("text NOT IN ('', '\r')").select(record.alias("record"), "broken")
