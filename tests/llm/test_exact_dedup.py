import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from narrascope.llm import exact_dedup as module
from narrascope.llm.exact_dedup import drop_exact_copies, exact_dedup
from tests.llm.cases import SCHEMA, awkward, clashing, frame


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def by_force(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[normal(text)].append(doc)
    return sorted((d, min(g), len(g), d == min(g)) for g in groups.values() for d in g)


@pytest.mark.parametrize("frequent", [512, 2])
@pytest.mark.parametrize("block", [7, 8192])
def test_equals_brute_force(spark, monkeypatch, block, frequent):
    monkeypatch.setattr(module, "_FREQUENT", frequent)
    rows = awkward(n=40)
    if block == 7:
        rows = [(i, (t or "")[:400] if t is not None else None) for i, t in rows]
    docs = clashing(frame(spark, rows))
    got = exact_dedup(docs, block_bytes=block, carry={"sha": lambda body: F.sha2(body, 256)})
    got = got.collect()
    assert sorted((r.id, r.keep_id, r.group_size, r.kept) for r in got) == by_force(rows)
    text = dict(rows)
    assert all(r.sha == hashlib.sha256(normal(text[r.id]).encode()).hexdigest() for r in got)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "x y"), (1, "x  y"), (1, "z"), (None, "x y"), (None, "q"), (None, "q"), (3, "z")]
    docs = frame(spark, rows)
    got = exact_dedup(docs).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3
    assert {(r.keep_id, r.group_size) for r in got} == {(1, 3), (1, 2), (None, 2)}
    left = drop_exact_copies(clashing(docs))
    assert left.columns == clashing(docs).columns
    assert sorted((r.doc_id or 0, normal(r.text)) for r in left.collect()) == [(0, "q"), (1, "x y"), (1, "z")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(docs).count() == 0 and drop_exact_copies(docs).columns == docs.columns


def test_native_plan(spark):
    docs = frame(spark, awkward(n=12))
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
