"""What the corpus operators share: row keys, quoted columns, Arrow batch steps."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned

#: White space of the ASCII range, the only white space of words, lines and normal texts.
SPACES = " \t\n\x0b\x0c\r"


def col(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the name of a long column that tells its rows apart, ordered as the ids.

    Where ids are whole numbers, unique and never null, as one cheap look at the id column
    shows, they are the keys. Else the rows are written once, in the order of their ids with
    nulls first, and numbered.
    """
    if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        copies = docs.groupBy(col(id_col).alias("id")).count()
        if not copies.filter("count > 1 OR id IS NULL").head(1):
            return docs, id_col
    row = unused(docs, "row_key")
    ordered = docs.repartitionByRange(col(id_col), F.rand(7)).sortWithinPartitions(col(id_col))
    return pinned(ordered.withColumn(row, F.monotonically_increasing_id()), "keyed"), row


def keep_rows(docs: DataFrame, key: str, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept`` (one column), as ``columns``."""
    wanted = kept.select(kept[kept.columns[0]].alias(key))
    return docs.join(wanted, key, "left_semi").select(*[col(c) for c in columns])


def in_batches(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str
) -> DataFrame:
    """Apply ``step`` to each Arrow batch; batches are bounded in rows and bytes by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = step(batch)
            yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have about ``most`` bytes, or one row where it has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def in_slices(
    df: DataFrame, make_step: Callable[[], Callable], schema: str, column: int
) -> DataFrame:
    """Apply a step made once per task to batches cut by the bytes of one text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make_step()
        for batch in batches:
            for part in slices(batch, column):
                yield step(part)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as the empty text."""
    return pc.fill_null(column, "").to_pylist()


_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(data: bytes, overlap: int, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text in lists of bounded size; each list begins with the last ``overlap``
    words before it, so that every window of ``overlap + 1`` words lies in one list."""
    at, words = 0, []
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.start() if gap else len(data)
        words = words[max(0, len(words) - overlap) :] if overlap else []
        words += data[at:end].split()
        yield words
        at = end


def lists_of(values: np.ndarray, lengths, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
