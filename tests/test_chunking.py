import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from narrascope.functions.splitting import split_text
from narrascope.operators import chunking
from narrascope.schema import CHUNK_SCHEMA, CHUNK_SEPARATORS, CLEANED


def complaint(spark, text, **values):
    row = {
        "product_category": "Credit Card", "Complaint ID": "123", "Product": "Credit card",
        "Issue": "Billing", "Sub-issue": "Late fee", "Company": "Acme", "State": "CA",
        "Date received": "2025-01-01", CLEANED: text, **values,
    }
    schema = ", ".join(f"`{c}` string" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize("chunker", [chunking.chunk_recursive, chunking.chunk_fixed])
def test_metadata_and_indices(spark, chunker):
    chunks = chunker(complaint(spark, " ".join(["word"] * 400)), 200, 20)
    assert chunks.schema.simpleString() == CHUNK_SCHEMA.simpleString()
    rows = sorted(chunks.collect(), key=lambda r: r.chunk_index)
    assert len(rows) == 11
    assert {r.total_chunks for r in rows} == {11}
    assert [r.chunk_index for r in rows] == list(range(11))
    assert rows[0].chunk_id == "123-0"
    assert (rows[0].complaint_id, rows[0].product_category, rows[0].sub_issue) == (
        "123", "Credit Card", "Late fee",
    )


@pytest.mark.parametrize("chunker", [chunking.chunk_recursive, chunking.chunk_fixed])
@pytest.mark.parametrize("text", ["   ", "", None, "　\n"])
def test_blank_text_gives_no_chunk(spark, chunker, text):
    assert chunker(complaint(spark, text)).count() == 0


def test_missing_values_become_empty_and_missing_id_unknown(spark):
    df = complaint(spark, "text", **{"Complaint ID": None, "State": None}).drop("Company")
    row = chunking.chunk_recursive(df).first()
    assert (row.chunk_id, row.complaint_id, row.state, row.company) == ("unknown-0", "", "", "")


def pieces(text, size, overlap, separators):
    """The chunking rules word for word: collect pieces one by one, without offsets."""
    separator, rest = separators[-1], []
    for at, candidate in enumerate(separators):
        if candidate == "" or candidate in text:
            separator, rest = candidate, separators[at + 1 :]
            break
    if separator == "":
        cut = list(text)
    else:
        head, *tail = text.split(separator)
        cut = [head, *(separator + part for part in tail)]
    chunks, short = [], []

    def flush():
        kept, total = [], 0
        for piece in short:
            if total + len(piece) > size and kept:
                chunks.append("".join(kept))
                while total > overlap or (total + len(piece) > size and total > 0):
                    total -= len(kept.pop(0))
            kept.append(piece)
            total += len(piece)
        if kept:
            chunks.append("".join(kept))
        short.clear()

    for piece in filter(None, cut):
        if len(piece) < size:
            short.append(piece)
            continue
        flush()
        chunks.extend(pieces(piece, size, overlap, rest) if rest else [piece])
    flush()
    return [c.strip() for c in chunks if c.strip()]


@settings(max_examples=400, deadline=None)
@given(
    st.text(alphabet="ab. \n", max_size=400),
    st.integers(2, 40).flatmap(lambda s: st.tuples(st.just(s), st.integers(0, s - 1))),
)
def test_recursive_split_follows_the_rules(text, limits):
    size, overlap = limits
    found = split_text(text, size, overlap)
    assert found == pieces(text, size, overlap, CHUNK_SEPARATORS)
    assert all(0 < len(c) <= size for c in found)


def test_fixed_split_equals_the_character_level(spark):
    random.seed(1)
    texts = ["".join(random.choices("ab é\U0001f600\n", k=n)) for n in (1, 49, 50, 51, 90, 91, 500, 1234)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], f"`Complaint ID` string, {CLEANED} string")
    rows = chunking.chunk_fixed(df, 50, 10).orderBy("complaint_id", "chunk_index").collect()
    for i, text in enumerate(texts):
        assert [r.text for r in rows if r.complaint_id == str(i)] == split_text(text, 50, 10, [""])


def test_statistics_trace_and_repeats(spark):
    chunks = chunking.chunk_fixed(complaint(spark, "x" * 950))
    row = chunking.chunk_statistics(chunks).first()
    assert (row.chunks, row.complaints, row.chunks_per_complaint) == (2, 1, 2.0)
    traced = chunking.trace_chunks(chunks, complaint(spark, "y").select("Complaint ID", CLEANED))
    assert {r[CLEANED] for r in traced.collect()} == {"y"}
    blank = chunks.withColumn("complaint_id", F.lit("")).unionByName(chunks)
    traced = chunking.trace_chunks(blank, complaint(spark, "y").select("Complaint ID", CLEANED))
    assert sorted(str(r[CLEANED]) for r in traced.collect()) == ["None", "None", "y", "y"]
    assert chunking.repeated_ids(chunks).count() == 0
    assert chunking.repeated_ids(chunks.unionByName(chunks)).count() == 2


def test_overlap_must_be_below_size(spark):
    with pytest.raises(ValueError):
        chunking.chunk_fixed(complaint(spark, "x"), 10, 10)
