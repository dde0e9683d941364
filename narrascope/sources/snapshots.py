"""Folders that are replaced as a whole: data aside first, then one small file that names it.

A snapshot is a JSON object in ``_snapshots/<number>``. It is written under another name and
renamed, which a file system does at once or not at all, so readers see the last snapshot or the
new one and a writer that fails changes nothing. Two writers cannot both take a number.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from narrascope.functions.bounds import release

_DIGITS = 12


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, folder = _place(spark, f"{root}/_snapshots")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def latest(spark: SparkSession, root: str) -> dict | None:
    """The last snapshot of a folder, with its ``number``; None if it has none."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


def _read(spark: SparkSession, root: str, number: int) -> dict:
    files, where = _place(spark, f"{root}/_snapshots/{number:0{_DIGITS}d}")
    source = files.open(where)
    try:
        told = json.loads(bytes(source.readAllBytes()).decode())
    finally:
        source.close()
    return told | {"number": number}


def new_part(root: str) -> str:
    """A name under ``root`` that nothing has."""
    return f"{root}/part-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, told: dict, number: int | None = None) -> int:
    """Make ``told`` the last snapshot and return its number, the next one if none is given."""
    if number is None:
        number = (_numbers(spark, root) or [-1])[-1] + 1
    files, target = _place(spark, f"{root}/_snapshots/{number:0{_DIGITS}d}")
    _, aside = _place(spark, f"{root}/_snapshots/.{uuid.uuid4().hex}")
    sink = files.create(aside, False)
    try:
        sink.write(bytearray(json.dumps(told).encode()))
    finally:
        sink.close()
    if files.exists(target) or not files.rename(aside, target):
        files.delete(aside, False)
        raise RuntimeError(f"snapshot {number} of {root} is already there")
    return number


def forget(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all snapshots but the last ``keep``, and the parts that only they name."""
    numbers = _numbers(spark, root)
    if len(numbers) <= keep:
        return
    kept = {part for number in numbers[-keep:] for part in _parts(_read(spark, root, number))}
    for number in numbers[:-keep]:
        for part in set(_parts(_read(spark, root, number))) - kept:
            release(spark, f"{root}/{part}")
        release(spark, f"{root}/_snapshots/{number:0{_DIGITS}d}")


def _parts(told: dict) -> list[str]:
    return [*told.get("parts", []), *(part for _, part in told.get("gone", []))]
