import numpy as np
import pytest
from pyspark.sql import functions as F

from narrascope.functions.embedding import hashed_words
from narrascope.schema import CATEGORY, CHUNK_SCHEMA, PRODUCT
from narrascope.sources import chunk_store, snapshots
from narrascope.streaming import running


def test_the_last_snapshot_counts(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.latest(spark, root) is None
    for i in range(4):
        (tmp_path / f"part-{i}").mkdir()
        assert snapshots.publish(spark, root, {"parts": [f"part-{i}"]}) == i
    with pytest.raises(RuntimeError, match="already there"):
        snapshots.publish(spark, root, {"parts": []}, 3)
    assert snapshots.latest(spark, root) == {"parts": ["part-3"], "number": 3}
    snapshots.forget(spark, root)
    assert sorted(p.name for p in tmp_path.glob("part-*")) == ["part-2", "part-3"]
    assert snapshots.latest(spark, root)["number"] == 3


def chunks(spark, texts):
    """One chunk per complaint, texts by number."""
    rows = [(f"{i}-0", text, str(i), ["x", "", None][i % 3], "p", "issue", "", "", "", "", 0, 1) for i, text in texts.items()]
    return spark.createDataFrame(rows, CHUNK_SCHEMA)


def broken():
    def encode(texts):
        raise RuntimeError("the encoder is broken")

    return encode


broken.name = "hashed_words"


def content(spark, path):
    rows = chunk_store.read_store(spark, path).select("chunk_id", "text", CATEGORY, "embedding").collect()
    return {r.chunk_id: (r.text, r[CATEGORY], tuple(r.embedding)) for r in rows}


def test_a_failing_encoder_leaves_the_old_store(spark, tmp_path):
    path = str(tmp_path / "store")
    chunk_store.write_store(chunks(spark, {1: "one text", 2: "another"}), path)
    before = content(spark, path)
    with pytest.raises(Exception, match="the encoder is broken"):
        chunk_store.write_store(chunks(spark, {1: "changed", 3: "new"}), path, broken)
    assert content(spark, path) == before
    chunk_store.write_store(chunks(spark, {3: "new"}), path)
    assert set(content(spark, path)) == {"3-0"}
    assert snapshots.latest(spark, path)["number"] == 1


def test_only_what_is_new_is_embedded(spark, tmp_path):
    path, other = str(tmp_path / "store"), str(tmp_path / "other")
    texts = {i: f"text number {i}" for i in range(100)}
    assert chunk_store.update_store(chunks(spark, texts), path) == (100, 0)
    for round_ in range(9):
        texts = {i: t for i, t in texts.items() if i != round_} | {50 + round_: f"changed {round_}", 200 + round_: "new"}
        assert chunk_store.update_store(chunks(spark, texts), path) == (2, 2)
        assert len(snapshots.latest(spark, path)["parts"]) <= 9
    assert chunk_store.update_store(chunks(spark, texts), path) == (0, 0)
    chunk_store.write_store(chunks(spark, texts), other)
    assert content(spark, path) == content(spark, other)
    back = texts | {0: "text number 0"}
    assert chunk_store.update_store(chunks(spark, back), path) == (1, 0)
    assert content(spark, path)["0-0"][0] == "text number 0"
    with pytest.raises(ValueError, match="encoder"):
        chunk_store.update_store(chunks(spark, back), path, lambda: hashed_words(8))


def complaints(spark, rows):
    return spark.createDataFrame(rows, f"`{PRODUCT}` string, `Consumer complaint narrative` string, `Complaint ID` string, {CATEGORY} string")


def test_a_repeated_batch_counts_once(spark, tmp_path):
    root = str(tmp_path / "state")
    first = complaints(spark, [("a", "two words", "1", "x"), (None, None, "2", "y"), ("a", " ", "3", None)])
    second = complaints(spark, [("a", "one", "4", "x")])
    for number, batch in [(0, first), (1, second), (1, second), (0, first)]:
        running.merged(spark, root, batch, number, running.add_counts, running.COUNTS_SCHEMA)
    counts = running.state(spark, root, running.COUNTS_SCHEMA)
    assert {r[PRODUCT]: r["count"] for r in running.counted_products(counts).collect()} == {"a": 3, None: 1}
    assert {r.words: r.complaints for r in running.counted_lengths(counts).collect()} == {2: 1, 1: 1, 0: 2}
    assert running.state(spark, str(tmp_path / "none"), running.COUNTS_SCHEMA).count() == 0


@pytest.mark.parametrize("n", [5, 40, 1000])
def test_samples_of_parts_are_those_of_the_whole(spark, tmp_path, n):
    from narrascope.operators.sampling import stratified_sample

    rng = np.random.default_rng(n)
    rows = [("p", f"t{i % 7}", str(i % 90), ["x", "x", "y", None][rng.integers(4)]) for i in range(200)]
    whole = complaints(spark, rows)
    want = sorted(map(tuple, stratified_sample(whole, n).collect()), key=repr)
    once = running.sample_of(running.least_rows(whole.repartition(4), n), n)
    assert sorted(map(tuple, once.collect()), key=repr) == want
    root, schema = str(tmp_path / "sample"), running.sample_schema(whole)
    for number, part in enumerate([rows[:3], rows[3:120], rows[120:]]):
        running.merged(
            spark, root, complaints(spark, part), number, lambda a, b: running._least(a, b, n, 42, CATEGORY, ("Complaint ID",)), schema
        )
    found = running.sample_of(running.state(spark, root, schema), n)
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_counts_of_empty_batches(spark, tmp_path):
    empty = complaints(spark, [])
    assert running.add_counts(None, empty).count() == 0
    assert running.sample_of(running.least_rows(empty, 5), 5).count() == 0
    assert running.complaint_counts(empty).agg(F.sum("rows")).head()[0] is None
