"""Raw export to cleaned complaints in one lineage: scan, filter, clean, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from narrascope.operators.cleaning import clean_narratives, filter_complaints, keep_columns
from narrascope.sources.complaints import (
    cache_as_parquet,
    is_parquet,
    load_cleaned,
    save_cleaned,
    scan_complaints,
)


def cleaned_complaints(raw: DataFrame) -> DataFrame:
    return clean_narratives(filter_complaints(keep_columns(raw)))


def preprocess(
    spark: SparkSession, raw_path: str, out_path: str, cache_path: str | None = None
) -> DataFrame:
    """Write the cleaned table and return it as read back.

    A CSV export is first cached as Parquet at ``cache_path``, so that later runs scan
    only the columns and row groups they need.
    """
    source = raw_path
    if not is_parquet(raw_path):
        source = cache_as_parquet(spark, raw_path, cache_path or f"{raw_path}.parquet")
    cleaned = cleaned_complaints(scan_complaints(spark, source))
    return load_cleaned(spark, save_cleaned(cleaned, out_path))
