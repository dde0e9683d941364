import random
import zlib
from collections import Counter

import pytest

from narrascope.llm import queries
from tests.llm.cases import frame, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with one repeated and one null id, and labels of some."""
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randint(60, 90))) for i in [*range(40), 7, None]]
    path = str(tmp_path_factory.mktemp("ids"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(0, 40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_token_counts", "op6_bpe_encode_decode", "op7_quality_rules", "op8_quality_classifier"])
def test_queries_return_the_real_ids(spark, folder, name):
    path, rows = folder
    found = getattr(queries, name)(spark, path)
    assert found.columns[0] == "doc_id"
    got = found.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    if name == "op5_token_counts":
        assert sorted((str(r.doc_id), r.n_bytes) for r in got) == sorted((str(i), len(t.encode())) for i, t in rows)
    if name == "op8_quality_classifier":
        assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
