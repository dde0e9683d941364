"""Proportional stratified samples of exact size, repeatable from a seed.

Bernoulli sampling (``sample``, ``sampleBy``) cannot give exact sizes, and ranking a
whole stratum would send a category with a third of all complaints to one task. Rows are
therefore ordered by a hash of their key and a stratum's quota is located on counts of
hash slices: rows below the slice that holds the last wanted row are taken as they are,
and only that one slice is ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrascope.functions.bounds import small_side
from narrascope.schema import CATEGORY, COMPLAINT_ID, SAMPLE_SEED, SAMPLE_SIZE


def sample_quotas(df: DataFrame, n: int = SAMPLE_SIZE, group: str = CATEGORY) -> DataFrame:
    """Rows to draw per stratum: ``(group, size, quota)``.

    Shares are rounded down and the rows left over go to the largest remainders, equal
    remainders to the first group name. Asking for at least all rows gives all rows. The
    windows see one row per stratum. A null stratum is a stratum.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("size"))
    return quotas_of(sizes, n, group)


def quotas_of(sizes: DataFrame, n: int, group: str) -> DataFrame:
    """``sample_quotas`` from the sizes of strata, one row each."""
    everything = Window.partitionBy()
    by_remainder = Window.partitionBy().orderBy(
        F.desc("remainder"), F.asc_nulls_first(group)
    )
    total = F.sum("size").over(everything)
    shares = (
        sizes.withColumn("total", total)
        .withColumn("raw", F.lit(float(n)) * F.col("size") / F.col("total"))
        .withColumn("base", F.floor("raw"))
        .withColumn("remainder", F.col("raw") - F.col("base"))
    )
    left_over = F.lit(n) - F.sum("base").over(everything)
    extra = (F.row_number().over(by_remainder) <= F.col("left_over")).cast("long")
    quota = F.when(F.lit(n) >= F.col("total"), F.col("size")).otherwise(
        F.least(F.col("base") + F.col("extra"), F.col("size"))
    )
    return (
        shares.withColumn("left_over", left_over)
        .withColumn("extra", extra)
        .select(group, "size", quota.alias("quota"))
    )


def draw_order(seed: int, key: Sequence[str]) -> Column:
    """Hash that puts rows in a random order fixed by the seed and the row key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(f"`{c}`") for c in key]))


def stratified_sample(
    df: DataFrame,
    n: int = SAMPLE_SIZE,
    seed: int = SAMPLE_SEED,
    group: str = CATEGORY,
    key: Sequence[str] = (COMPLAINT_ID,),
    slice_digits: int = 4,
    rank_limit: int = 1_000_000,
    shuffle: bool = False,
) -> DataFrame:
    """Draw exactly the quota of each stratum without replacement.

    The same rows come back for any partitioning. ``key`` should identify a row.
    ``slice_digits`` hex digits of the hash make the slices. Should a last slice still
    hold more than ``rank_limit`` rows, as when many rows lack an id, it is sliced once
    more by a hash of whole rows. ``shuffle`` puts the result in draw order.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = draw_order(seed, key)
    rows = df.withColumns({"_order": order, "_slice": F.substring(order, 1, slice_digits)})
    certain, edge, largest = _cut(rows, lambda slices: _wanted(slices, n, group), group)
    sample = certain.select(*columns, "_order")

    tie = F.hex(F.xxhash64(*columns))
    if largest > rank_limit:
        wanted = edge.wanted
        finer = F.concat("_order", F.substring(tie, 1, slice_digits))
        certain, edge, _ = _cut(edge.rows.withColumn("_slice", finer), lambda _: wanted, group)
        sample = sample.unionByName(certain.select(*columns, "_order"))

    # Copies of a row are interchangeable: count them before ranking, repeat them after.
    copies = edge.rows.groupBy(*columns, "_order", "_take").agg(F.count("*").alias("_copies"))
    ranked = Window.partitionBy(group).orderBy("_order", tie)
    before = F.sum("_copies").over(
        ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("_copies")
    taken = (
        copies.withColumn("_left", F.least(F.col("_take") - before, F.col("_copies")))
        .where("_left > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_left"))))
    )
    sample = sample.unionByName(taken.select(*columns, "_order"))
    return (sample.orderBy("_order") if shuffle else sample).drop("_order")


class _Edge(NamedTuple):
    """Rows of the last slices, and how many of them each stratum still wants."""

    rows: DataFrame
    wanted: DataFrame


def _wanted(slices: DataFrame, n: int, group: str) -> DataFrame:
    sizes = slices.groupBy(group).agg(F.sum("_rows").alias("size"))
    return quotas_of(sizes, n, group).select(
        F.col(group).alias("_group"), F.col("quota").alias("_wanted")
    )


def _cut(
    rows: DataFrame, wanted: Callable[[DataFrame], DataFrame], group: str
) -> tuple[DataFrame, _Edge, int]:
    """Rows below the slice that holds the last wanted row, and the rows of that slice.

    Also gives the number of rows in the largest such slice. Only counts per slice are
    shuffled; the limits, one row per stratum, are joined to the rows where they lie.
    """
    slices = rows.groupBy(group, "_slice").agg(F.count("*").alias("_rows"))
    running = F.sum("_rows").over(
        Window.partitionBy(group)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    limits = small_side(
        slices.withColumn("_running", running)
        .join(
            wanted(slices).where("_wanted > 0"), F.col(group).eqNullSafe(F.col("_group"))
        )
        .where("_running >= _wanted AND _running - _rows < _wanted")
        .select(
            "_group",
            F.col("_slice").alias("_last"),
            (F.col("_wanted") - (F.col("_running") - F.col("_rows"))).alias("_take"),
            "_rows",
        )
    )
    largest = limits.agg(F.max("_rows")).first()[0] or 0
    marked = rows.drop("_take").join(limits, F.col(group).eqNullSafe(F.col("_group")))
    edge = marked.where("_slice = _last").drop("_group", "_last", "_rows")
    return (
        marked.where("_slice < _last"),
        _Edge(edge, limits.select("_group", F.col("_take").alias("_wanted"))),
        largest,
    )


def sample_balance(before: DataFrame, after: DataFrame, group: str = CATEGORY) -> DataFrame:
    """Rows and share per stratum, before and after sampling."""

    def shares(df: DataFrame, stage: str) -> DataFrame:
        counts = df.groupBy(group).agg(F.count("*").alias("complaints"))
        total = counts.agg(F.sum("complaints")).scalar()
        return counts.select(
            F.lit(stage).alias("stage"), group, "complaints", (F.col("complaints") / total).alias("share")
        )

    return shares(before, "before").unionByName(shares(after, "after"))
