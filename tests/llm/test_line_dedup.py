from collections import defaultdict

import pytest

from narrascope.llm.line_dedup import line_dedup
from tests.llm.cases import SCHEMA, awkward, clashing, frame

WHITE = " \t\n\x0b\x0c\r"


def by_force(rows, least=20, docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE).translate(lower)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < docs or max(held[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 5])
def test_equals_brute_force(spark, batches):
    rows = awkward(seed=4, n=80)
    rows += [(100, "É" * 19 + "\n" + "É" * 20), (101, "É" * 20), (102, "É" * 20 + "\r\n" + "É" * 20)]
    got = line_dedup(clashing(frame(spark, rows)), batches=batches)
    got = sorted((r.row_key, r.n_lines, r.n_dropped, r.text) for r in got.collect())
    assert got == by_force(rows) and sum(r[2] for r in got) > 5


def test_repeated_rows_null_ids_and_empty_table(spark):
    line = "a line that is long enough to be compared"
    got = line_dedup(frame(spark, [(1, line), (1, line), (None, line), (None, None)])).collect()
    assert sorted((r.n_lines, r.n_dropped, r.text) for r in got) == [(1, 0, ""), (1, 0, line), (1, 1, ""), (1, 1, "")]
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
