import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from narrascope.llm import simhash as module
from narrascope.llm.components import components
from narrascope.llm.simhash import drop_near_copies, fingerprint, near_links, simhash_groups
from tests.llm.cases import SCHEMA, awkward, clashing, frame, words


def slow_print(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for white in "\t\n\x0b\x0c\r":
        text = text.replace(white, " ")
    found = [w for w in text.translate(lower).split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, vertices):
    parent = {v: v for v in vertices}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {v: find(v) for v in vertices}


@pytest.mark.parametrize("block", [30, 1 << 18])
def test_fingerprint(monkeypatch, block):
    monkeypatch.setattr(module, "_BLOCK_BYTES", block)
    rng = random.Random(3)
    texts = ["", " \n", "One", "a B", "A b C", words(rng, 400), "x\x1cy z q É \n r", words(rng, 50).upper()]
    assert [fingerprint(t) for t in texts] == [slow_print(t) for t in texts]


def clustered(rng, n):
    """Fingerprints around a few centres, many of them close to each other."""
    out = set()
    centres = [rng.getrandbits(64) for _ in range(4)]
    while len(out) < n:
        value = rng.choice(centres)
        for _ in range(rng.randrange(0, 9)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return np.array(sorted(out), np.uint64).view(np.int64).tolist()


@pytest.mark.parametrize("largest", [1 << 16, 20])
def test_links_connect_what_is_near(spark, largest):
    fps = clustered(random.Random(largest), 500)
    got = near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), largest).collect()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert all(near(r.a, r.b) for r in got)
    every = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if near(a, b)]
    assert roots([(r.a, r.b) for r in got], fps) == roots(every, fps)
    assert len(got) < len(every)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(70)]
    links = path + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    random.Random(1).shuffle(links)
    got = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots(links, {v for link in links for v in link})


def test_groups_equal_brute_force(spark):
    rows = awkward(seed=8, n=70)
    rows += [(200 + i, rows[5][1] + f" end{i}") for i in range(12)]
    docs = clashing(frame(spark, rows))
    got = simhash_groups(docs).collect()
    prints = {i: slow_print(t or "") for i, t in rows}
    by_print = defaultdict(list)
    for i, p in prints.items():
        by_print[p].append(i)
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = roots(pairs, set(prints))
    assert {r.id: r.component_id for r in got} == want and len(got) == len(rows)
    assert {r.id: r.fp & (2**64 - 1) for r in got} == prints
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = simhash_groups(frame(spark, [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None)])).collect()
    assert sorted((r.component_id is None, r.kept) for r in got) == [(False, False), (False, False), (False, True), (True, True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(empty).count() == 0 and drop_near_copies(empty).count() == 0
