"""Label mapping, complaint filter and narrative cleaning: narrow steps without a shuffle."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrascope.functions.text import computed_once, has_text, normalise
from narrascope.schema import (
    CATEGORY,
    CATEGORY_OF_PRODUCT,
    CLEANED,
    COMPLAINT_COLUMNS,
    COMPLAINT_ID,
    NARRATIVE,
    PRODUCT,
)


def keep_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in COMPLAINT_COLUMNS])


def category_of(label: Column) -> Column:
    """Category of a raw label, by exact match; null for any other label."""
    pairs = chain.from_iterable(CATEGORY_OF_PRODUCT.items())
    return F.element_at(F.create_map(*map(F.lit, pairs)), label)


def with_category(df: DataFrame, product: str = PRODUCT) -> DataFrame:
    return df.withColumn(CATEGORY, category_of(F.col(product)))


def filter_complaints(
    df: DataFrame, product: str = PRODUCT, narrative: str = NARRATIVE
) -> DataFrame:
    """Complaints of the four categories that have a visible narrative.

    The label test is made on the raw labels, where it reaches the file scan; a test on
    the mapped category would not.
    """
    kept = df.where(
        F.col(product).isin(*CATEGORY_OF_PRODUCT)
        & F.col(narrative).isNotNull()
        & has_text(F.col(narrative))
    )
    return with_category(kept, product)


def clean_narratives(
    df: DataFrame, narrative: str = NARRATIVE, cleaned: str = CLEANED
) -> DataFrame:
    """Add the normalised narrative and drop complaints it leaves empty."""
    return computed_once(df, cleaned, normalise(F.col(narrative))).where(F.col(cleaned) != "")


def preview(df: DataFrame, n: int = 5, order: str = COMPLAINT_ID, width: int = 300) -> DataFrame:
    """Raw and cleaned narrative of the first ``n`` complaints by id, side by side."""
    return (
        df.orderBy(order)
        .limit(n)
        .select(
            order,
            F.substring(NARRATIVE, 1, width).alias("raw"),
            F.substring(CLEANED, 1, width).alias("cleaned"),
        )
    )


def stage_counts(df: DataFrame, product: str = PRODUCT, narrative: str = NARRATIVE) -> DataFrame:
    """Complaints left after each stage, per category, from a single pass.

    Stages: ``raw`` (all rows, category null where unmapped), ``mapped``, ``narrative``
    and ``cleaned``.
    """
    mapped = with_category(df, product).select(CATEGORY, narrative)
    wanted = F.col(CATEGORY).isNotNull() & F.coalesce(has_text(F.col(narrative)), F.lit(False))
    # Only complaints that reach the last stage are cleaned.
    text = F.when(wanted, normalise(F.col(narrative)))
    staged = computed_once(mapped.withColumn("wanted", wanted), CLEANED, text)
    counts = staged.groupBy(CATEGORY).agg(
        F.count("*").alias("raw"),
        F.count(CATEGORY).alias("mapped"),
        F.count_if("wanted").alias("narrative"),
        F.count_if(F.col(CLEANED) != "").alias("cleaned"),
    )
    return counts.unpivot(
        CATEGORY, ["raw", "mapped", "narrative", "cleaned"], "stage", "complaints"
    )
