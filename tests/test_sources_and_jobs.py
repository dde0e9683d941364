import random

import pytest

from narrascope.functions.embedding import embed, hashed_words
from narrascope.operators.chunking import chunk_fixed
from narrascope.plans.indexing import build_store
from narrascope.plans.preprocess import cleaned_complaints, preprocess
from narrascope.schema import CLEANED, COMPLAINT_COLUMNS, CORRUPT, NARRATIVE, RAW_SCHEMA
from narrascope.sources import complaints as S
from narrascope.sources.chunk_store import read_store
from narrascope.streaming.complaint_stream import chunk_stream, read_complaint_stream, write_stream

HEADER = ",".join(COMPLAINT_COLUMNS)


def export(tmp_path, *lines, name="raw.csv"):
    path = tmp_path / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def row(narrative, ident, product="Credit card"):
    return f'2024-01-01,"{product}",,Fees,,{narrative},Acme,CA,{ident}'


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = export(
        tmp_path,
        row('"he said ""pay"", twice"', 1),
        row('"first line\nsecond, line"', 2),
        row('a 5" pipe', 3),
        row('""', 4),
        row("", 5),
    )
    found = {r["Complaint ID"]: r[NARRATIVE] for r in S.read_csv(spark, path).collect()}
    assert found == {
        "1": 'he said "pay", twice', "2": "first line\nsecond, line", "3": 'a 5" pipe', "4": "", "5": None,
    }


def in_splits(spark, size, read):
    """``read()`` collected with splits of ``size`` bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return read().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_a_quote_closed_by_the_next_line(spark, tmp_path, size):
    fine = [row("fine", i) for i in range(12)]
    path = export(tmp_path, *fine[:6], row('"never closed', 90), *fine[6:], row('"nor this', 91), row("end", 92))
    rows = in_splits(spark, size, lambda: S.read_csv(spark, path, keep_corrupt=True))
    good = [r["Complaint ID"] for r in rows if r[CORRUPT] is None]
    corrupt = [r[CORRUPT] for r in rows if r[CORRUPT]]
    assert sorted(corrupt) == sorted([row('"never closed', 90), row('"nor this', 91)])
    assert sorted(good, key=int) == [*map(str, range(12)), "92"]


@pytest.mark.parametrize("size, fourth", [(90, '"ok, text"'), (1 << 20, '"ok text"'), (1 << 20, '"ok\ntext"')])
def test_a_stray_quote_takes_no_other_record(spark, tmp_path, size, fourth):
    texts = ["fine", '"stray', "plain", fourth, "plain"]
    lines = [f"2024-01-01,Credit card,,Fees,,{t},Acme,CA,{i}" for i, t in enumerate(texts, 1)]
    path = export(tmp_path, *lines)
    rows = in_splits(spark, size, lambda: S.read_csv(spark, path, keep_corrupt=True))
    assert [r[CORRUPT] for r in rows if r[CORRUPT]] == [lines[1]]
    assert {r["Complaint ID"]: r[NARRATIVE] for r in rows if not r[CORRUPT]} == {
        "1": "fine", "3": "plain", "4": fourth.strip('"'), "5": "plain",
    }
    assert len(in_splits(spark, size, lambda: S.read_csv(spark, path))) == 5


def test_a_stray_quote_in_two_columns(spark, tmp_path):
    (tmp_path / "two.csv").write_text('a,b\n1,fine\n2,"bad\n3,plain\n4,"x"y\n5,"good"\n6\n')
    schema = spark.createDataFrame([], "a string, b string").schema
    rows = S.read_csv(spark, str(tmp_path / "two.csv"), schema, True).collect()
    assert sorted(r[CORRUPT] for r in rows if r[CORRUPT]) == ['2,"bad', '4,"x"y', "6"]
    assert sorted((r.a, r.b) for r in rows if not r[CORRUPT]) == [("1", "fine"), ("3", "plain"), ("5", "good")]


def slow_records(text, fields):
    """(record, broken) by the rules of ``csv_blocks``, one character at a time."""
    lines = text.split("\n")

    def read(at):
        """(fate, line behind): a record from line ``at`` on."""
        joined, count, state, i = "\n".join(lines[at:]), 1, "start", 0
        while i < len(joined):
            c = joined[i]
            if state == "inside":
                if c == '"' and joined[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "closed"
            elif c == "\n":
                break
            elif state == "closed" and c == "\r" and joined[i + 1 : i + 2] in ("\n", ""):
                pass
            elif c == ",":
                state, count = "start", count + 1
            elif state == "closed":
                return "broken", None
            else:
                state = "inside" if c == '"' and state == "start" else "plain"
            i += 1
        if state == "inside":
            return "open", None
        return ("whole" if count == fields else "broken"), at + joined[:i].count("\n") + 1

    at, out = 0, []
    while at < len(lines):
        if lines[at] in ("", "\r"):
            at += 1
            continue
        fate, end = read(at)
        if fate == "whole":
            out.append(("\n".join(lines[at:end]), False))
            at = end
            continue
        quoted = lines[at].startswith('"') or ',"' in lines[at]
        there = at + 1
        if quoted or fate == "open":
            while there < len(lines) and (
                lines[there] in ("", "\r") or (read(there)[0] != "whole" and lines[there].count(",") != fields - 1)
            ):
                there += 1
        out.append(("\n".join(lines[at:there]), True))
        at = there
    return out


def test_broken_files_equal_a_slow_reader(spark, tmp_path):
    pick = random.Random(11)
    parts = ["a", "b,c,d\n", ",", '"', '""', "\n", '"\n', ',"', "x,y,z\n", '",', "é", '1,"t, ""q""",2\n', '1,"two\nlines",3\n']
    schema = spark.createDataFrame([], "a string, b string, c string").schema
    for i in range(2):
        text = "a,b,c\n" + "".join(pick.choice(parts) for _ in range(60))
        path = tmp_path / f"slow{i}.csv"
        path.write_text(text)
        want = sorted(r.rstrip("\n") for r, broken in slow_records(text, 3)[1:] if broken)
        whole = sum(not broken for _, broken in slow_records(text, 3)[1:])
        for size in (1 << 20, 50):
            rows = in_splits(spark, size, lambda: S.read_csv(spark, str(path), schema, True))
            assert sorted(r[CORRUPT].rstrip("\n") for r in rows if r[CORRUPT]) == want, (text, size)
            assert sum(r[CORRUPT] is None for r in rows) == whole, (text, size)


def test_a_header_with_a_line_break(spark, tmp_path):
    (tmp_path / "head.csv").write_text('a,"b\nc"\n1,2\n3,"4\n5"\n')
    rows = S.scan_complaints(spark, str(tmp_path / "head.csv"))
    assert rows.columns == ["a", "b\nc"] and sorted(map(tuple, rows.collect())) == [("1", "2"), ("3", "4\n5")]


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_one_unclosed_quote_in_the_middle(spark, tmp_path, size):
    lines = [f"2024-01-01,Credit card,,Fees,,text {i},Acme,CA,{i}" for i in range(20)]
    lines[10] = '2024-01-01,Credit card,,Fees,,"never closed,Acme,CA,10'
    path = export(tmp_path, *lines)
    rows = in_splits(spark, size, lambda: S.read_csv(spark, path, keep_corrupt=True))
    assert len(rows) == 20 and [r[CORRUPT] for r in rows if r[CORRUPT]] == [lines[10]]
    assert {r["Complaint ID"] for r in rows if not r[CORRUPT]} == {str(i) for i in range(20) if i != 10}
    cache = S.cache_as_parquet(spark, path, str(tmp_path / "cache.parquet"))
    assert S.corrupt_rows(spark.read.parquet(cache)) == 1 and spark.read.parquet(cache).count() == 20


FIELDS = ["", '""', "plain", '"a, b"', '"two\nlines"', '"q ""x"" q"', 'stray 5" pipe', '"\n\n"',
          '"ends with quote"""', '"""starts"', "é😀", '" , ""\n"", "', '"' + "long " * 40 + '\n"']


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_splits_do_not_change_whole_records(spark, tmp_path, line_end):
    """Splits far smaller than a record: borders fall inside fields, quotes and breaks."""
    pick = random.Random(1)
    lines = [",".join(pick.choice(FIELDS) for _ in range(3)) for _ in range(40)]
    path = tmp_path / "part.csv"
    path.write_bytes(("a,b,c\n" + "\n".join(lines) + "\n").replace("\n", line_end).encode())
    schema = spark.createDataFrame([], "a string, b string, c string").schema
    found = [in_splits(spark, n, lambda: S.read_csv(spark, str(path), schema, True)) for n in (61, 250, 1 << 20)]
    assert len(found[0]) == len([x for x in lines if x != ",,"]) + lines.count(",,")
    assert sorted(map(repr, found[0])) == sorted(map(repr, found[1])) == sorted(map(repr, found[2]))


def test_splits_do_not_change_broken_files(spark, tmp_path):
    pick = random.Random(5)
    parts = ["a", ",", '"', '""', "\n", '"\n', ',"', "x y", '",', "\r\n", "é"]
    schema = spark.createDataFrame([], "a string, b string, c string").schema
    for i in range(6):
        text = "a,b,c\n" + "".join(pick.choice(parts) for _ in range(120)) + pick.choice(["", "\n", '"', 'a,,"tail\n'])
        path = tmp_path / f"broken{i}.csv"
        path.write_bytes(text.encode())
        one, many = (in_splits(spark, n, lambda: S.read_csv(spark, str(path), schema, True)) for n in (1 << 20, 11))
        assert sorted(map(repr, one)) == sorted(map(repr, many)), text


def test_headers_are_compared(spark, tmp_path):
    export(tmp_path, row("a", 1), name="one.csv")
    (tmp_path / "two.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception, match="begins with the columns"):
        S.read_csv(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]).collect()


def test_scan_by_suffix_and_header(spark, tmp_path, raw):
    raw.write.parquet(str(tmp_path / "x.parquet"))
    assert S.scan_complaints(spark, str(tmp_path / "x.parquet")).count() == 4
    path = export(tmp_path, row("text", 1))
    assert S.scan_complaints(spark, path).columns == COMPLAINT_COLUMNS
    assert {f.dataType.simpleString() for f in S.scan_complaints(spark, path).schema} == {"string"}


def test_cache_is_written_once(spark, tmp_path):
    first, second = export(tmp_path, row("a", 1)), export(tmp_path, row("b", 2), row("c", 3), name="b.csv")
    cache = str(tmp_path / "cache.parquet")
    S.cache_as_parquet(spark, first, cache)
    S.cache_as_parquet(spark, second, cache)
    assert spark.read.parquet(cache).count() == 1
    S.cache_as_parquet(spark, second, cache, overwrite=True)
    assert spark.read.parquet(cache).count() == 2
    (tmp_path / "cache.parquet" / "_SUCCESS").unlink()
    S.cache_as_parquet(spark, first, cache)
    assert spark.read.parquet(cache).count() == 1
    one_file = str(next((tmp_path / "cache.parquet").glob("*.parquet")))
    assert S.cache_as_parquet(spark, second, one_file) == one_file and spark.read.parquet(one_file).count() == 1


def test_jobs_end_to_end(spark, tmp_path):
    path = export(
        tmp_path,
        *[row(f'"I am writing to file a complaint about fee {i}. {"word " * 200}"', i) for i in range(20)],
        row("XXXX", 90), row("other", 91, "Mortgage"),
    )
    out = str(tmp_path / "cleaned")
    cleaned = preprocess(spark, path, out, str(tmp_path / "cache.parquet"))
    assert cleaned.count() == 20
    assert all(r[CLEANED].startswith("fee ") for r in cleaned.collect())
    stats = build_store(spark, out, str(tmp_path / "store"), sample_size=6).first()
    assert stats.sampled_complaints == 6 and stats.chunks == stats.indexed >= 12
    assert stats.persist_dir == str(tmp_path / "store")


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame(
        [("2024", "Credit card", None, "Fees", None, f"fee {i} " * 100, "A", "CA", str(i)) for i in range(9)]
        + [("2024", "Mortgage", None, "Fees", None, "x", "A", "CA", "m")],
        RAW_SCHEMA,
    )
    source = str(tmp_path / "in")
    rows.repartition(3).write.parquet(source)
    stream = chunk_stream(read_complaint_stream(spark, source, max_files=1), chunk_fixed, hashed_words)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_stream(stream, out, state, "product_category").awaitTermination()
    found = read_store(spark, out)
    batch = chunk_fixed(cleaned_complaints(rows))
    assert sorted(r.chunk_id for r in found.collect()) == sorted(r.chunk_id for r in batch.collect())
    assert {len(r.embedding) for r in found.collect()} == {384}
    # Nothing new: a second run adds nothing.
    again = chunk_stream(read_complaint_stream(spark, source, max_files=1), chunk_fixed, hashed_words)
    write_stream(again, out, state, "product_category").awaitTermination()
    assert spark.read.parquet(out).count() == found.count()


def test_embedding_batches_and_nulls(spark):
    seen = []

    def factory():
        def encode(texts):
            assert len(texts) <= 3 and None not in texts
            return [[len(t), 0.0] for t in texts]

        return encode

    df = spark.createDataFrame([("ab",), (None,), ("",), ("c",), ("d",)], "t string").coalesce(1)
    vectors = [r[0] for r in df.select(embed(df.t, factory, 3)).collect()]
    assert vectors == [[1.0, 0.0], None, [0.0, 0.0], [1.0, 0.0], [1.0, 0.0]]


def test_csv_round_trip_keeps_null_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("", ' x\n"y", '), (None, "")], "p string, q string")
    path = S.save_csv(df, str(tmp_path / "t"))
    back = S.read_csv(spark, path, df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("method", ["entry", "registry"])
def test_registry(spark, method):
    import __spark_entry__ as E

    if method == "entry":
        assert E.entry(spark).count() == 4
    else:
        assert set(E.oracle_sql()) <= set(E.queries())
