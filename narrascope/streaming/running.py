"""Results that are kept up to date as rows arrive: each batch is merged into the last state.

A state is a small table in a folder of snapshots numbered by batch. A batch that is run again
after a failure finds its number taken and changes nothing, so every row counts once. Merging
reads the last state and the new rows only.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from narrascope.functions.bounds import pinned
from narrascope.functions.text import has_text, word_count
from narrascope.operators.retrieval import nearest_chunks
from narrascope.operators.sampling import draw_order, quotas_of
from narrascope.schema import CATEGORY, COMPLAINT_ID, NARRATIVE, PRODUCT, SAMPLE_SEED, SAMPLE_SIZE, TOP_K
from narrascope.sources.snapshots import forget, latest, new_part, publish

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def merged(spark: SparkSession, root: str, batch: DataFrame, number: int, merge: Merge, schema: T.StructType) -> None:
    """Make ``merge(last state, batch)`` the state of batch ``number``, if it is not yet."""
    told = latest(spark, root)
    if told is not None and told["number"] >= number:
        return
    part = new_part(root)
    merge(None if told is None else state(spark, root, schema), batch).write.parquet(part)
    publish(spark, root, {"parts": [part.rsplit("/", 1)[-1]]}, number)
    forget(spark, root)


def state(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The last state; empty before the first batch."""
    told = latest(spark, root)
    if told is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{part}" for part in told["parts"]])


def keep_merged(arriving: DataFrame, root: str, checkpoint: str, merge: Merge, schema: T.StructType) -> StreamingQuery:
    """Merge a stream into the state at ``root``; all that is available now, then it stops."""

    def run(batch: DataFrame, number: int) -> None:
        merged(batch.sparkSession, root, batch, number, merge, schema)

    writer = arriving.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


# --- Standing questions ---------------------------------------------------------


def answers_schema(questions: DataFrame, chunks: DataFrame, question_id: str, chunk_id: str) -> T.StructType:
    return T.StructType([
        T.StructField("question_id", questions.schema[question_id].dataType),
        T.StructField("rank", T.IntegerType()),
        T.StructField("chunk_id", chunks.schema[chunk_id].dataType),
        T.StructField("distance", T.DoubleType()),
    ])


def keep_answers(
    questions: DataFrame,
    arriving: DataFrame,
    root: str,
    checkpoint: str,
    k: int = TOP_K,
    *,
    question_id: str = "question_id",
    chunk_id: str = "chunk_id",
    **options,
) -> StreamingQuery:
    """The top ``k`` of standing questions over all chunks that have arrived.

    A batch is searched like a store of its own; its k rows a question and the k of the state
    are ranked together, so the state equals ``nearest_chunks`` over all chunks at any time.
    """

    def merge(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        found = nearest_chunks(questions, batch, k, question_id=question_id, chunk_id=chunk_id, **options)
        both = found if before is None else found.unionByName(before)
        order = Window.partitionBy("question_id").orderBy("distance", "chunk_id")
        return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    return keep_merged(arriving, root, checkpoint, merge, answers_schema(questions, arriving, question_id, chunk_id))


# --- Statistics -------------------------------------------------------------------

COUNTS_SCHEMA = T.StructType([
    T.StructField("statistic", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("words", T.IntegerType()), T.StructField("rows", T.LongType()),
])


def complaint_counts(complaints: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """Complaints by product, by presence of a narrative and by its number of words: all that
    the profile is read from, in one pass. Counts of parts add up to those of the whole."""
    text, none = F.col(f"`{narrative}`"), F.lit(None)

    def counted(statistic: str, label: Column, words: Column) -> Column:
        names = F.lit(statistic).alias("statistic"), label.cast("string").alias("label"), words.cast("int").alias("words")
        return F.struct(*names)

    each = F.array(
        counted("product", F.col(PRODUCT), none),
        counted("narrative", F.coalesce(has_text(text), F.lit(False)), none),
        counted("length", none, word_count(text)),
    )
    one = complaints.select(F.explode(each).alias("one")).select("one.*")
    return one.groupBy("statistic", "label", "words").agg(F.count("*").alias("rows"))


def add_counts(before: DataFrame | None, batch: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    both = complaint_counts(batch, narrative)
    if before is not None:
        both = both.unionByName(before)
    return both.groupBy("statistic", "label", "words").agg(F.sum("rows").alias("rows"))


def keep_counts(complaints: DataFrame, root: str, checkpoint: str, narrative: str = NARRATIVE) -> StreamingQuery:
    """Counts of all complaints that have arrived; a row per product and per number of words."""
    return keep_merged(complaints, root, checkpoint, lambda a, b: add_counts(a, b, narrative), COUNTS_SCHEMA)


def counted_products(counts: DataFrame) -> DataFrame:
    """``product_distribution`` from counts."""
    rows = counts.where("statistic = 'product'").groupBy(F.col("label").alias(PRODUCT))
    return rows.agg(F.sum("rows").alias("count")).orderBy(F.desc("count"), PRODUCT)


def counted_lengths(counts: DataFrame) -> DataFrame:
    """Frequencies of word counts, from which the length statistics are read."""
    rows = counts.where("statistic = 'length'").groupBy("words")
    return rows.agg(F.sum("rows").alias("complaints"))


# --- A sample ---------------------------------------------------------------------


def keep_sample(
    arriving: DataFrame,
    root: str,
    checkpoint: str,
    n: int = SAMPLE_SIZE,
    seed: int = SAMPLE_SEED,
    group: str = CATEGORY,
    key: tuple[str, ...] = (COMPLAINT_ID,),
) -> StreamingQuery:
    """The rows that a sample of what has arrived may need, and how many have been seen.

    The state holds the ``n`` first rows in drawing order of every stratum (its quota is never
    more) and the stratum's size in ``_seen``; the least of a union are among the least of its
    parts. ``sample_of`` draws from it.
    """
    return keep_merged(arriving, root, checkpoint, lambda a, b: _least(a, b, n, seed, group, key), sample_schema(arriving))


def sample_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema.fields, T.StructField("_order", T.StringType()), T.StructField("_seen", T.LongType())])


def least_rows(
    rows: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, group: str = CATEGORY, key: tuple[str, ...] = (COMPLAINT_ID,)
) -> DataFrame:
    """The state of ``keep_sample`` for one table, which is read once.

    Every task keeps at most ``n`` rows of a stratum and its count. They are all that is
    written and exchanged, which pays while tasks times ``n`` is far less than the table.
    """
    return _least(None, rows, n, seed, group, key)


def _least(before: DataFrame | None, rows: DataFrame, n: int, seed: int, group: str, key) -> DataFrame:
    schema = sample_schema(rows)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    # Behind the drawing order what decides between rows of one key.
    order = F.concat(draw_order(seed, key), F.hex(F.xxhash64(*columns)))
    ordered = rows.withColumn("_order", order).withColumn("_seen", F.lit(None).cast("long"))
    kept = pinned(ordered.mapInArrow(_kept(n, group, schema), schema), "least")
    if before is not None:
        kept = kept.unionByName(before)
    # Rows that carry a count stand for their task; one row of a stratum at least has one.
    sizes = kept.groupBy(F.col(group).alias("_group")).agg(F.sum("_seen").alias("_all"))
    order = Window.partitionBy(group).orderBy("_order")
    first = kept.drop("_seen").withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n)
    joined = first.join(sizes, F.col(group).eqNullSafe(F.col("_group")), "left")
    seen = F.when(F.col("_place") == 1, F.col("_all"))
    return joined.withColumn("_seen", seen).select(*columns, "_order", "_seen")


def _kept(n: int, group: str, schema: T.StructType):
    """The ``n`` first rows of each stratum in a task; the first carries the number seen."""

    def run(batches):
        import pyarrow as pa

        held, seen = None, {}
        place = schema.fieldNames().index(group)
        for batch in batches:
            labels = pc.value_counts(batch.column(place))
            for one in labels.to_pylist():
                seen[one["values"]] = seen.get(one["values"], 0) + one["counts"]
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows > 2 * n * max(1, len(seen)):
                held = _first(held, place, n)
        if held is None:
            return
        held = _first(held, place, n).combine_chunks()
        labels, counts, given = held.column(place).to_pylist(), [], set()
        for label in labels:
            counts.append(None if label in given else seen[label])
            given.add(label)
        yield from held.set_column(held.num_columns - 1, "_seen", pa.array(counts, pa.int64())).to_batches()

    return run


def _first(rows, place: int, n: int):
    import numpy as np

    rows = rows.sort_by("_order")
    codes = pc.dictionary_encode(rows.column(place).combine_chunks(), null_encoding="encode").indices.to_numpy()
    keep = np.zeros(rows.num_rows, bool)
    for code in np.unique(codes):
        keep[np.flatnonzero(codes == code)[:n]] = True
    return rows.filter(keep)


def sample_of(state: DataFrame, n: int = SAMPLE_SIZE, group: str = CATEGORY) -> DataFrame:
    """The exact proportional sample of all rows that a state has seen."""
    sizes = state.groupBy(group).agg(F.sum("_seen").alias("size"))
    quotas = quotas_of(sizes, n, group).select(F.col(group).alias("_group"), "quota")
    columns = [F.col(f"`{c}`") for c in state.columns if c not in ("_order", "_seen")]
    order = Window.partitionBy(group).orderBy("_order")
    placed = state.withColumn("_place", F.row_number().over(order))
    drawn = placed.join(quotas, F.col(group).eqNullSafe(F.col("_group"))).where("_place <= quota")
    return drawn.select(*columns)
