"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (hash, documents holding the line, last of them), bucketed by the hash
and sorted in each bucket, so that runs meet in merge joins without a shuffle. Documents
come in batches, the largest ids first. A batch merge-anti-joins the runs: lines that no run
has are added with the batch's last document as their owner, for known lines only the count
of documents is added. Two runs of one level are merged into one of the next, so there are
never more runs than the logarithm of the batches.

Lines are hashed with 128 bits of XXH3. Hot lines are counted before any shuffle.

Defined results: null or empty text is one empty line; lines whose key is shorter than
``min_chars`` always stay; a line repeated in a document counts that document once and, if
the line goes, all its places go; every row is a document of its own, also with a repeated
or null id (nulls before all others, equal ids in any order); empty tables give empty
results; columns other than id and text are not looked at.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned, release, shared_path
from narrascope.llm.common import SPACES, col, in_batches, keyed, texts_of

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
_HASH = ["h1", "h2"]
_SPACES = SPACES.encode()


def line_key(line: bytes) -> bytes:
    """What is compared of a line: without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(_SPACES).lower()


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "surrogatepass"))


def _hashed_lines(min_chars: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, numbers, digests, first = [], [], [], []
        for row, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            seen = set()
            for number, line in enumerate(text.encode().split(b"\n")):
                key = line_key(line)
                if len(key) < min_chars or _code_points(key) < min_chars:
                    continue
                digest = xxhash.xxh3_128_digest(key)
                rows.append(row)
                numbers.append(number)
                digests.append(digest)
                first.append(digest not in seen)
                seen.add(digest)
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(numbers, pa.int32()),
             pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(first, pa.bool_())],
            ["row", "line", "h1", "h2", "first"],
        )

    return step


class LineRuns:
    """The runs of one corpus: ``add`` a batch, then ask which lines are ``frequent``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix = f"line_run_{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.levels: list[tuple[int, str]] = []

    def _write(self, rows: DataFrame) -> str:
        """A table in the shared folder; the warehouse may be a folder of one machine."""
        name, path = f"{self.prefix}_{uuid.uuid4().hex}", shared_path(self.spark, "line-run")
        self.paths[name] = path
        (
            rows.repartition(self.buckets, *_HASH).write.format("parquet").option("path", path)
            .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name)
        )
        return name

    def drop(self, names: list[str] | None = None) -> None:
        """Drop tables and delete their files, all that are left if none are named."""
        for name in list(self.paths) if names is None else names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            release(self.spark, self.paths.pop(name))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (row, h1, h2), one row for each line of each document."""
        batch = lines.groupBy(*_HASH).agg(F.count("*").alias("docs"), F.max("row").alias("owner"))
        known = F.lit(False)
        for i, (_, name) in enumerate(self.levels):
            run = self.spark.table(name).select(*_HASH, F.lit(True).alias(f"run{i}"))
            batch = batch.join(run.hint("merge"), _HASH, "left")
            known = known | F.col(f"run{i}").isNotNull()
        # Only lines that are in no run bring an owner.
        fresh = F.when(~known, F.col("owner")).alias("owner")
        self.levels.append((0, self._write(batch.select(*_HASH, "docs", fresh))))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge_last_two()

    def _merge_last_two(self) -> None:
        (level, old), (_, new) = self.levels[-2:]
        name = self._write(self._merged(self.spark.table(old), self.spark.table(new)))
        self.levels[-2:] = [(level + 1, name)]
        self.drop([old, new])

    @staticmethod
    def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
        new = new.select(*_HASH, F.col("docs").alias("more"), F.col("owner").alias("later"))
        return old.join(new.hint("merge"), _HASH, "full").select(
            *_HASH,
            (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"),
            F.coalesce("owner", "later").alias("owner"),
        )

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, owner) of the lines that at least ``min_docs`` documents hold."""
        tables = [self.spark.table(name) for _, name in self.levels]
        whole = tables[0]
        for table in tables[1:]:
            whole = self._merged(whole, table)
        found = pinned(whole.filter(F.col("docs") >= min_docs).select(*_HASH, "owner"), "frequent")
        self.drop()
        self.levels = []
        return found


def _rebuilt(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts without the given lines."""
    counts, dropped, texts = [], [], []
    gone = batch.column(2).to_pylist()
    for text, lines in zip(texts_of(batch.column(1)), gone):
        parts = text.split("\n")
        counts.append(len(parts))
        dropped.append(len(lines or ()))
        if lines:
            lines = set(lines)
            text = "\n".join(part for i, part in enumerate(parts) if i not in lines)
        texts.append(text)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts)],
        ["row_key", "n_lines", "n_dropped", "text"],
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """One row per document: row_key (its id where ids are unique), n_lines, n_dropped, text.

    A line whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents stays only in the document with the largest id.
    """
    docs, row = keyed(docs, id_col)
    pairs = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    parts = [i / batches for i in range(1, batches)]
    cuts = pairs.approxQuantile("row", parts, 0.001) if parts else []
    batch = sum((F.when(F.col("row") <= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    hashed = in_batches(
        pairs, _hashed_lines(min_chars), "row long, line int, h1 long, h2 long, first boolean"
    )
    path = shared_path(docs.sparkSession, "lines")
    hashed.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = docs.sparkSession.read.schema(
        "row long, line int, h1 long, h2 long, first boolean, batch int"
    ).parquet(path)

    runs = LineRuns(docs.sparkSession)
    try:
        for number in range(batches):
            runs.add(lines.filter((F.col("batch") == number) & F.col("first")).select("row", *_HASH))
        frequent = runs.frequent(min_docs)
    except Exception:
        runs.drop()
        raise
    gone = lines.join(frequent, _HASH).filter("row <> owner")
    gone = gone.groupBy("row").agg(F.collect_list("line").alias("gone"))
    with_gone = pairs.join(gone, "row", "left").select("row", "text", "gone")
    return in_batches(with_gone, _rebuilt, "row_key long, n_lines long, n_dropped long, text string")
