import random
import re

import numpy as np
import pytest

from narrascope.llm import substring_dedup as module
from narrascope.llm.substring_dedup import substring_dedup
from tests.llm.cases import SCHEMA, clashing, frame, words


def slow_hash(data: bytes) -> list[int]:
    out = []
    for i in range(len(data)):
        out.append(sum(int(module._GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) & 0xFFFF)
    return out


def test_rolling_hash_and_cuts():
    rng = random.Random(1)
    texts = [words(rng, n).encode() for n in (1, 40, 300)] + [b"a" * 1000, b"x"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    assert module._rolling(data).tolist() == slow_hash(data.tobytes())
    first, last = module._cuts(data, np.cumsum([len(t) for t in texts]))
    assert first[0] == 0 and last[-1] == data.size and (first[1:] == last[:-1]).all()
    assert (last - first).max() <= module.MAX_CHUNK and (last > first).all()
    # Alone or behind others, a text is cut alike.
    at = len(texts[0]) + len(texts[1])
    alone, _ = module._cuts(np.frombuffer(texts[2], np.uint8), np.array([len(texts[2])]))
    assert [f - at for f in first.tolist() if at <= f < at + len(texts[2])] == alone.tolist()


@pytest.mark.parametrize("seed", range(2))
def test_planted_passages_go_and_the_rest_stays(spark, seed):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (51, 55, 60, 80, 200, 500)]
    short = words(rng, 30)
    rows, want = [(0, None), (1, ""), (2, words(rng, 3))], {0: None, 1: ""}
    want[2] = rows[2][1]
    for doc in range(3, 60):
        a, b = words(rng, rng.randint(1, 120)), words(rng, rng.randint(1, 120))
        passage = passages[doc % len(passages)]
        if doc % 7 == 0:
            passage = short
        rows.append((doc, f"{a} {passage} {b}"))
        stays = passage == short or doc == min(d for d in range(3, 60) if d % 7 and d % len(passages) == doc % len(passages))
        want[doc] = rows[-1][1] if stays else f"{a} {b}"
    docs = clashing(frame(spark, rows))
    got, spans = substring_dedup(docs)
    assert got.columns == [*docs.columns, spans]
    squeezed = lambda t: t if t is None else t.split()
    every = sum(t is not None and t != dict(rows)[i] for i, t in want.items())
    for r in got.collect():
        text = dict(rows)[r.doc_id]
        if want[r.doc_id] == text:
            assert r.text == text
        else:
            # A word beside the passage may be the same in its other place.
            assert len(squeezed(want[r.doc_id])) - 3 <= len(squeezed(r.text)) <= len(squeezed(want[r.doc_id]))
            every -= 1
        if text is not None:
            left, at = "", 0
            for span in r[spans]:
                left, at = left + text[at : span.start], span.end
            assert r.text == left + text[at:]
    assert every == 0


def test_copies_repeated_rows_null_ids_and_empty_table(spark):
    rng = random.Random(9)
    text = words(rng, 300)
    rows = [(1, text), (1, text), (None, text), (2, text + " tail"), (3, "no repeat here")]
    got, spans = substring_dedup(frame(spark, rows))
    texts = sorted((r.text for r in got.collect()), key=len)
    assert texts[:2] == ["", ""] and texts[2].strip() == "tail" and texts[3:] == ["no repeat here", text]
    repeated = words(rng, 70)
    got, _ = substring_dedup(frame(spark, [(1, f"{repeated} {words(rng, 20)} {repeated}")]))
    assert len(got.head().text.split()) == 90
    assert substring_dedup(spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_passages_of_too_few_words_stay_side_by_side(spark):
    rng = random.Random(4)
    a, b, c = words(rng, 40), words(rng, 40), words(rng, 60)
    near = words(rng, 80).split()
    rows = [(1, f"{words(rng, 30)} {a} {words(rng, 30)}"), (2, f"{words(rng, 30)} {b} {words(rng, 30)}"),
            (3, " ".join(near)), (4, f"{words(rng, 20)} {a} {b} {words(rng, 20)}"),
            (5, " ".join(near[:39] + near[40:])), (6, f"{words(rng, 20)} {a} {c} {words(rng, 20)}"),
            (7, f"{words(rng, 20)} {c} {b} {words(rng, 20)}")]
    # The parts of a passage stand elsewhere too.
    parts = [" ".join(c.split()[i : i + 20]) for i in (0, 20, 40)]
    rows += [(-1 - i, f"{words(rng, 30)} {part} {words(rng, 30)}") for i, part in enumerate(parts)]
    got = {r.doc_id: r.text for r in substring_dedup(frame(spark, rows))[0].collect()}
    want = dict(rows)
    assert all(got[i] == t for i, t in want.items() if i != 7)
    assert len(got[7].split()) in range(79, 82) and b in got[7] and c[20:-20] not in got[7]


def repeated_words(rows, n=50):
    """Of each text its words' places, and which are in a window of ``n`` that stands earlier."""
    seen, out = set(), {}
    for ident, text in rows:
        data = (text or "").encode()
        places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
        found = set()
        for i in range(len(places) - n + 1):
            window = data[places[i][0] : places[i + n - 1][1]]
            if window in seen:
                found.update(range(i, i + n))
            seen.add(window)
        out[ident] = places, found
    return out


def test_all_windows_of_fifty_words(spark):
    """Every window of 50 words of the documents against what is cut, in their order."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want, text = repeated_words(rows), dict(rows)
    got, spans = substring_dedup(docs)
    repeated = cut = others = 0
    for row in got.collect():
        places, found = want[row.doc_id]
        edges = [tuple(len(text[row.doc_id][:at].encode()) for at in (s.start, s.end)) for s in row[spans]]
        gone = {i for i, (a, b) in enumerate(places) if any(x <= a and b <= y for x, y in edges)}
        repeated, cut, others = repeated + len(found), cut + len(gone & found), others + len(gone - found)
    assert cut >= 0.99 * repeated > 0 and others <= 0.001 * repeated


def test_a_phrase_repeated_is_left_once(spark):
    rng = random.Random(3)
    a, b = words(rng, 40), words(rng, 40)
    rows = [(1, f"{a} " + "ab cd " * 100 + b), (2, f"{b} " + "x" * 50 + " orantion" * 300 + f" {a}"), (3, f"{b} " + "Und " * 58 + "x")]
    got = {r.doc_id: r.text for r in substring_dedup(frame(spark, rows))[0].collect()}
    assert all(len(got[i].split()) < 40 + 40 + 20 for i in got)
    assert got[1].startswith(a) and got[1].endswith(b) and got[2].startswith(b) and got[2].endswith(a)
