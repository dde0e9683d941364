"""Reading raw exports, caching them as Parquet, and persisting the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.schema import CLEANED_SCHEMA, CORRUPT, RAW_SCHEMA
from narrascope.sources.csv_blocks import csv_records, text_lines

# A character no export holds: with it an empty field reads as null and a quoted empty
# field as an empty string, and both survive a round trip.
_NULL_MARK = "\u0000"


def _with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _csv_options() -> dict[str, str]:
    return {
        "multiLine": "true",
        "quote": '"',
        "escape": '"',
        "nullValue": _NULL_MARK,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "maxCharsPerColumn": "-1",
    }


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_SCHEMA,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header, every column a string, quotes doubled, line breaks in quotes.

    ``schema`` gives the columns in their order, as every file's header has to. Files of any
    size are read by as many tasks as they have splits, with the same rows for any splits.
    A record whose quotes or number of fields are broken is a row of nulls: with
    ``keep_corrupt`` its text is in the corrupt-record column. It takes no other record along.
    """
    return parsed_csv(text_lines(spark, path), schema, keep_corrupt)


def parsed_csv(lines: DataFrame, schema: T.StructType = RAW_SCHEMA, keep_corrupt: bool = False) -> DataFrame:
    """``read_csv`` for located lines of whole files, as those of one batch of a stream."""
    return _parsed(csv_records(lines, schema.fieldNames()), schema, keep_corrupt)


def _parsed(records: DataFrame, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` STRING" for f in _with_corrupt_column(schema))
    whole = F.when(~F.col("broken"), F.col("record"))
    parsed = records.select(F.from_csv(whole, ddl, _csv_options()).alias("row"), "record", "broken")
    # As a generator the parsed row is computed once and not once per column.
    rows = parsed.select(F.inline(F.array("row")), F.when(F.col("broken"), F.col("record")).alias("_broken"))
    if not keep_corrupt:
        return rows.drop(CORRUPT, "_broken")
    return rows.withColumn(CORRUPT, F.coalesce("_broken", CORRUPT)).drop("_broken")


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-string schema from the header of a CSV export, which may have line breaks in quotes;
    only the beginning of a file is read."""
    options = {"header": True, "inferSchema": False, "multiLine": True, "quote": '"', "escape": '"'}
    head = spark.read.options(**options).csv(path)
    return T.StructType([T.StructField(c, T.StringType()) for c in head.columns])


def is_parquet(path: str) -> bool:
    """True for a ``.parquet`` path, file or directory, on any file system."""
    return path.rstrip("/").lower().endswith(".parquet")


def scan_complaints(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Lazy scan of a Parquet or CSV export, told apart by the suffix."""
    if is_parquet(path):
        return spark.read.parquet(path)
    return read_csv(spark, path, schema or header_schema(spark, path))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(file_system.exists(hadoop_path))


def _finished(spark: SparkSession, parquet_path: str) -> bool:
    """A cache of one file, or a directory whose writing came to its end."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parquet_path)
    file_system = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    one_file = file_system.exists(jvm_path) and file_system.getFileStatus(jvm_path).isFile()
    return bool(one_file) or _exists(spark, f"{parquet_path.rstrip('/')}/_SUCCESS")


def cache_as_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    overwrite: bool = False,
    schema: T.StructType | None = None,
) -> str:
    """Convert a CSV export to Parquet once and return the Parquet path.

    A finished cache, a single file too, is left alone unless ``overwrite`` is set; a
    directory without a success marker is an interrupted run and is written again. Records
    that do not parse are in it too, with their text in the corrupt-record column, where
    ``corrupt_rows`` counts them. The caller names the
    cache, one per export.
    """
    if overwrite or not _finished(spark, parquet_path):
        rows = read_csv(
            spark, csv_path, schema or header_schema(spark, csv_path), keep_corrupt=True
        )
        rows.write.mode("overwrite").parquet(parquet_path)
    return parquet_path


def corrupt_rows(cached: DataFrame) -> int:
    """Records of a cache that did not parse as the export's columns."""
    return cached.where(F.col(CORRUPT).isNotNull()).count() if CORRUPT in cached.columns else 0


def save_cleaned(df: DataFrame, path: str) -> str:
    """Write the cleaned table, replacing an older one, and return the path."""
    df.write.mode("overwrite").parquet(path)
    return path


def load_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEANED_SCHEMA).parquet(path)


def save_csv(df: DataFrame, path: str) -> str:
    """Write a table as CSV with a header; null and empty string stay apart."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def load_csv(spark: SparkSession, path: str, schema: T.StructType = CLEANED_SCHEMA) -> DataFrame:
    return read_csv(spark, path, schema)
