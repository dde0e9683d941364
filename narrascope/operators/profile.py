"""Counts and narrative-length statistics of a complaint table.

Every operator makes one pass and shuffles partial aggregates only: rows per label, or
rows per distinct word count. A label that holds most of the table is counted map-side
and arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrascope.functions.text import computed_once, has_text, word_count
from narrascope.schema import CATEGORY, NARRATIVE, PRODUCT, WORDS


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def frame_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def label_counts(df: DataFrame, label: str = PRODUCT) -> DataFrame:
    """Rows per label, the null label included."""
    return df.groupBy(label).agg(F.count("*").alias("count"))


def product_distribution(df: DataFrame, label: str = PRODUCT) -> DataFrame:
    """Rows per label, most frequent first, equal counts by label."""
    return label_counts(df, label).orderBy(F.desc("count"), F.asc_nulls_last(label))


def top_products(df: DataFrame, n: int = 15, label: str = PRODUCT) -> DataFrame:
    """The ``n`` most frequent labels."""
    return product_distribution(df, label).limit(n)


def label_shares(df: DataFrame, label: str = CATEGORY) -> DataFrame:
    """Rows per label and their share of all rows."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def label_cardinality(df: DataFrame, label: str = PRODUCT) -> DataFrame:
    """Number of distinct labels; null is not a label."""
    return df.agg(F.count_distinct(label).alias("labels"))


def narrative_presence(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """One row: complaints with and without a visible narrative."""
    present = F.count_if(has_text(F.col(narrative)))
    return df.agg(
        present.alias("with_narrative"),
        (F.count("*") - present).alias("without_narrative"),
    )


def add_narrative_length(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    return df.withColumn(WORDS, word_count(F.col(narrative)))


def narrative_lengths(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """The word count alone, so that no text leaves the scan."""
    return df.select(word_count(F.col(narrative)).alias(WORDS))


def length_frequencies(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """Complaints per word count, the table all length statistics are read from.

    It has one row per distinct word count, so quantiles and bins over it cost the same
    for a thousand complaints as for a trillion.
    """
    counted = computed_once(df.select(narrative), WORDS, word_count(F.col(narrative)))
    return counted.groupBy(WORDS).agg(F.count("*").alias("complaints"))


def _mean(words: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(words * weight), F.sum(weight))


def _deviation(words: Column, weight: Column) -> Column:
    n = F.sum(weight)
    total = F.sum(words * weight).cast("double")
    squares = F.sum(words.cast("double") * words * weight)
    return F.sqrt(F.greatest(F.try_divide(squares - total * total / n, n - 1), F.lit(0.0)))


def length_describe(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """One row describing the word counts of all complaints, those without words included.

    Quartiles are observed values: the one whose place, counted from zero, is nearest to
    the quantile's share of the last place.
    """
    words, weight = F.col(WORDS), F.col("complaints")
    # Windows over the frequencies, which have one row per distinct word count.
    through = Window.partitionBy().orderBy(WORDS)
    ranked = length_frequencies(df, narrative).withColumns(
        {"through": F.sum(weight).over(through), "total": F.sum(weight).over(Window.partitionBy())}
    )

    def quantile(share: float) -> Column:
        place = F.round(F.lit(share) * (F.col("total") - 1))
        return F.min(F.when(F.col("through") > place, words))

    return ranked.agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("count"),
        F.lit(0).cast("long").alias("null_count"),
        _mean(words, weight).alias("mean"),
        _deviation(words, weight).alias("std"),
        F.min(words).alias("min"),
        quantile(0.25).alias("p25"),
        quantile(0.5).alias("p50"),
        quantile(0.75).alias("p75"),
        F.max(words).alias("max"),
    )


def length_summary(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """One row on complaints with words: moments, quartiles, 95th percentile and maximum.

    Percentiles are exact and interpolated.
    """
    lengths = length_frequencies(df, narrative).where(F.col(WORDS) > 0)
    words, weight = F.col(WORDS), F.col("complaints")
    points = F.percentile(words, F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.95))), weight)
    return lengths.agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("count"),
        _mean(words, weight).alias("mean"),
        _deviation(words, weight).alias("std"),
        F.min(words).alias("min"),
        points.alias("points"),
        F.max(words).alias("max"),
    ).select(
        "count",
        "mean",
        "std",
        "min",
        F.col("points")[0].alias("p25"),
        F.col("points")[1].alias("median"),
        F.col("points")[2].alias("p75"),
        (F.col("points")[2] - F.col("points")[0]).alias("iqr"),
        F.col("points")[3].alias("p95"),
        "max",
    )


def length_histogram(df: DataFrame, bins: int = 60, narrative: str = NARRATIVE) -> DataFrame:
    """Complaints per bin of equal width over the non-zero word counts; filled bins only."""
    lengths = length_frequencies(df, narrative).where(F.col(WORDS) > 0)
    # The bounds come from the frequencies, which have one row per distinct word count.
    everything = Window.partitionBy()
    low, high = F.min(WORDS).over(everything), F.max(WORDS).over(everything)
    place = F.floor(F.try_divide(F.col(WORDS) - F.col("low"), F.col("width")))
    return (
        lengths.withColumns({"low": low, "width": (high - low) / F.lit(float(bins))})
        .withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(
            F.min(F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
            F.sum("complaints").alias("complaints"),
        )
    )


def length_bands(df: DataFrame, narrative: str = NARRATIVE) -> DataFrame:
    """One row: complaints in the very short, short, long and very long bands.

    The bands are fewer than 5, fewer than 20, more than 300 and more than 1,000 words;
    the shares are of complaints with at least one word.
    """
    lengths = length_frequencies(df, narrative).where(F.col(WORDS) > 0)
    words, weight = F.col(WORDS), F.col("complaints")

    def within(band: Column) -> Column:
        return F.coalesce(F.sum(F.when(band, weight)), F.lit(0))

    total = F.sum(weight)
    return lengths.agg(
        F.coalesce(total, F.lit(0)).alias("narratives"),
        within(words < 5).alias("very_short"),
        within(words < 20).alias("short"),
        within(words > 300).alias("long"),
        within(words > 1000).alias("very_long"),
        F.try_divide(within(words < 20), total).alias("short_share"),
        F.try_divide(within(words > 300), total).alias("long_share"),
    )
