"""Tables that queries write for themselves come in files, and texts in runs, of bounded size."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from narrascope.functions import splitting
from narrascope.functions.embedding import embed
from verification import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, files", [
    ("large_csv_scan", 2), ("broken_csv_scan", 2), ("csv_stream", 4), ("running_counts", 4), ("running_sample", 4),
])
def test_large_tables_are_written_by_several_tasks(spark, monkeypatch, name, files):
    query = getattr(queries, name)
    whole = sorted(map(repr, query(spark, SF).collect()))
    written, shared = [], queries.shared_path
    monkeypatch.setattr(queries, "shared_path", lambda *of: written.append(shared(*of)) or written[-1])
    monkeypatch.setattr(queries, "FILE_BYTES", 1 << 14)
    assert sorted(map(repr, query(spark, SF).collect())) == whole
    parts = [spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).count()
             for path in written if any(of in path for of in ("one-file", "broken", "arriving"))]
    assert parts and min(parts) >= files


def test_chunks_of_a_prebuilt_store_are_cut_once(spark, monkeypatch):
    kept, pinned = [], queries.pinned
    monkeypatch.setattr(queries, "pinned", lambda df, name: kept.append(name) or pinned(df, name))
    assert queries.prebuilt_store(spark, SF).count() > 0
    assert kept == ["prebuilt-chunks"]


def test_texts_are_cut_in_runs_of_bounded_size():
    texts = pa.array(["a" * 40, None, "", "é" * 30, "b" * 500, "c"])
    runs = [part.to_pylist() for part in splitting._few_texts(texts, 100)]
    assert sum(runs, []) == texts.to_pylist()
    assert max(len(run) for run in runs) < len(texts)
    assert not list(splitting._few_texts(texts.slice(0, 0)))


def test_no_more_texts_than_a_call_takes_are_held_as_strings(spark):
    rows = spark.range(0, 300, 1, 1).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"))

    def factory():
        def encode(texts):
            assert len(texts) <= 64
            return np.array([[1.0, float(t)] for t in texts])

        return encode

    found = rows.select("text", embed(F.col("text"), factory, 64).alias("v")).collect()
    assert all((r.text is None) == (r.v is None) for r in found)
    assert all(r.v[1] / r.v[0] == pytest.approx(float(r.text), rel=1e-4) for r in found if r.text is not None)
