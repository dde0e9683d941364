"""Exact dedup by block naming, without hashes standing in for texts.

A normalised text is cut into blocks of fixed size. Equal blocks get the same whole number
and different blocks different ones, by their rank in a sort; then adjacent numbers are
named in pairs, level by level, until one number is left of each document. Texts of equal
block count are equal exactly when their last numbers are.

Only DataFrame operations are used. A text is shuffled once, as blocks. Blocks that are very
frequent are named from their distinct values and joined back, which a skewed join can
split; pairs are always named that way.

Defined results: a null text counts as empty, the empty text is one empty block; null ids
come after all others when the row that stays is chosen; of repeated rows with the same id
exactly one stays; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned, small_rows
from narrascope.llm.common import col, keep_rows, keyed

BLOCK_BYTES = 8192
#: Numbers are ``bucket * 2^43 + rank``: a sort of each bucket names the blocks in it.
_BUCKETS, _RANKS, _SALTS = 1 << 20, 1 << 43, 64
#: A block with fewer copies is named where it lies. At most so many others are set apart.
_FREQUENT, _MOST_FREQUENT = 512, 100_000
_NONE = -(1 << 62)


def normal_text(text: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    # Single spaces are already as they should be and are not matched.
    runs = "[\\t\\n\\x0B\\f\\r][ \\t\\n\\x0B\\f\\r]*| [ \\t\\n\\x0B\\f\\r]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def _blocks(body: Column, size: int) -> Column:
    last = F.greatest(F.lit(1), F.ceil(F.length(body) / size).cast("int")) - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(body, i * size + 1, F.lit(size))
    )


def _named(df: DataFrame, digest: Column, *value: str) -> DataFrame:
    """``name`` of each value: its rank among the values that share a bucket."""
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*value))
    return df.withColumn("bucket", F.pmod(digest, F.lit(_BUCKETS))).withColumn(
        "name", F.col("bucket") * _RANKS + rank
    )


def _block_names(pieces: DataFrame) -> DataFrame:
    """One row (row, n, pos, name, head) for each block, written once.

    Frequent blocks are dealt over salts and named in each. The first row of each such name
    keeps its block, from which all names of a block are brought to a common one, below zero.
    """
    often = pieces.groupBy("digest").count().filter(F.col("count") >= _FREQUENT)
    often = often.orderBy(F.desc("count")).limit(_MOST_FREQUENT).select("digest")
    frequent = small_rows(often, _MOST_FREQUENT)
    # At most _MOST_FREQUENT whole numbers.
    frequent = F.broadcast(pieces.sparkSession.createDataFrame(frequent, "digest long"))
    dealt = pieces.join(frequent.withColumn("hot", F.lit(True)), "digest", "left").withColumns({
        "bucket": F.pmod("digest", F.lit(_BUCKETS)),
        "salt": F.when(F.col("hot"), F.pmod(F.xxhash64("row", "pos"), F.lit(_SALTS - 1)) + 1).otherwise(0),
    })
    order = Window.partitionBy("bucket", "salt").orderBy("block")
    name = F.col("bucket") * _RANKS + F.col("salt") * (_RANKS // _SALTS) + F.dense_rank().over(order)
    first = (F.rank().over(order) == F.row_number().over(order)) & F.col("hot")
    named = dealt.select(
        "row", "n", "pos", "head", "hot", name.alias("name"), F.when(first, F.col("block")).alias("block")
    )
    named = pinned(named, "block-names")
    kept = ["row", "n", "pos", "name", "head"]
    salted = named.filter("block IS NOT NULL").select("block", "name")
    common = _named(salted.select("block").distinct(), F.xxhash64("block"), "block")
    common = common.select("block", (-F.col("name")).alias("common"))
    common = salted.join(common, "block").select("name", "common")
    hot = named.filter("hot").join(common, "name").drop("name").withColumnRenamed("common", "name")
    return named.filter("hot IS NULL").select(*kept).unionByName(hot.select(*kept))


def _pair_names(level: DataFrame) -> DataFrame:
    """Adjacent names (2i, 2i + 1) as one name at i; a last one without partner is a pair too."""
    odd = F.col("pos") % 2 == 1
    pairs = level.groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max(F.when(~odd, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(_NONE)).alias("b"),
    )
    names = _named(pairs.select("a", "b").distinct(), F.xxhash64("a", "b"), "a", "b")
    return pairs.join(names.select("a", "b", "name"), ["a", "b"]).select("row", "n", "pos", "name")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: dict[str, Callable[[Column], Column]] | None = None,
    block_bytes: int = BLOCK_BYTES,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: row_key, id, keep_id, group_size, kept, and what ``carry`` adds.

    Texts are equal when they are after ``normal_text``. Of equal texts the row with the
    smallest id stays. ``carry`` names further columns, as functions of the normalised text
    in UTF-8, that are computed in the one pass over the texts. ``row_key`` is the id where ids are unique,
    or ``row_col``, a column known to tell rows apart.
    """
    docs, row = (docs, row_col) if row_col else keyed(docs, id_col)
    carry = carry or {}
    body = F.col("body")
    head = F.struct("doc", *[make(body).alias(name) for name, make in carry.items()])
    # A column of its own, as it is used several times and is costly. There is always a block;
    # the outer form spares a filter on their number, which would make them once more.
    texts = docs.select(
        col(row).alias("row"), col(id_col).alias("doc"), normal_text(col(text_col)).cast("binary").alias("body")
    )
    pieces = texts.select("row", head.alias("head"), _blocks(body, block_bytes).alias("blocks")).select(
        "row", F.size("blocks").alias("n"), "head", F.posexplode_outer("blocks").alias("pos", "block")
    )
    pieces = pieces.withColumn("head", F.when(F.col("pos") == 0, F.col("head")))
    pieces = pieces.withColumn("digest", F.xxhash64("block"))
    first = _block_names(pieces)

    longest = first.agg(F.max("n")).head()[0] or 1
    level = first.filter("n > 1").select("row", "n", "pos", "name")
    done = []
    for height in range(1, math.ceil(math.log2(longest)) + 1):
        level = pinned(_pair_names(level), "pair-names")
        done.append(level.filter(F.col("n") <= 1 << height).select("row", "name"))
        level = level.filter(F.col("n") > 1 << height)
    heads = first.filter("pos = 0")
    whole = heads.filter("n = 1").select("row", "n", "name", "head")
    for names in done:
        whole = whole.unionByName(
            heads.filter("n > 1").drop("name").join(names, "row").select("row", "n", "name", "head")
        )

    order = F.struct(F.col("head.doc").isNull(), "head.doc", "row")
    groups = whole.groupBy("n", "name").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    # Written, so that the join reads both sides by their own shuffle and can split a large group.
    groups = pinned(groups.filter("size > 1"), "copies")
    alone = F.col("size").isNull()
    return whole.join(groups, ["n", "name"], "left").select(
        F.col("row").alias("row_key"),
        F.col("head.doc").alias("id"),
        F.when(alone, F.col("head.doc")).otherwise(F.col("first.doc")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        *[F.col(f"head.{name}").alias(name) for name in carry],
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are."""
    columns = docs.columns
    rows, row = keyed(docs, id_col)
    kept = exact_dedup(rows, id_col, text_col, row_col=row).filter("kept").select("row_key")
    return keep_rows(rows, row, kept, columns)
