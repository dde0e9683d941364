import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from narrascope.llm import collocations as module
from narrascope.llm.collocations import MisraGries, collocations, frequent_phrases
from tests.llm.cases import awkward, clashing


def counted(rows):
    """Exact counts of phrases of one to four words, by language, and words of each."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts, totals


def brute_force(rows, threshold, top):
    counts, totals = counted(rows)
    out = []
    for lang, count in counts.items():
        good = {p: n for p, n in count.items() if n >= threshold and " " in p}
        gone = set()
        for phrase, n in good.items():
            words = phrase.split(" ")
            for size in range(2, len(words)):
                for i in range(len(words) - size + 1):
                    inner = " ".join(words[i : i + size])
                    if 100 * n >= 80 * count[inner]:
                        gone.add(inner)
        found = []
        for phrase, a in good.items():
            words = phrase.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = count[" ".join(words[:k])], count[" ".join(words[k:])]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            if phrase not in gone:
                found.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["of", "the", "Of", "a", "é", "naïve", "x y", "b", "c", "d", "あ"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(["new york city", "of the", *vocabulary]))
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b"]))
        rows.append((rng.choice(["en", "fr", None, "und"]), "".join(parts)))
    rows += [("en", None), ("en", ""), (None, " . "), ("xx", "single")]
    return rows + rows[:20]


def result(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert df.columns == names
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)


def test_equals_brute_force(spark):
    rows = texts(1)
    assert result(collocations(clashing(frame(spark, rows)), threshold=5, top=40)) == brute_force(rows, 5, 40)


def test_frequent_phrases_are_exact(spark):
    rows = texts(2) + [("de", t) for _, t in awkward(3)]
    frequent, totals = frequent_phrases(frame(spark, rows), threshold=4)
    counts, words = counted(rows)
    got = {(r.lang, r.phrase): r["count"] for r in frequent.collect()}
    assert got == {(lang, p): n for lang, c in counts.items() for p, n in c.items() if n >= 4}
    assert {r.lang: r.n for r in totals.collect()} == {lang: n for lang, n in words.items() if n}


def test_empty_table_and_no_frequent_phrase(spark):
    assert collocations(frame(spark, [("en", "x")]).limit(0)).count() == 0
    assert collocations(frame(spark, [("en", "a b c"), (None, None)])).count() == 0


def test_long_texts_are_cut_between_pieces():
    text = b"ab cd, ef gh. " * 1000 + b"x" * 5000 + b" y z." + b"tail"
    parts = list(module._segments(text, 1000))
    assert b"".join(parts) == text and all(p[-1:] in b".,;:!?" for p in parts[:-1])
    assert max(map(len, parts)) < 7000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=30), min_size=1, max_size=12), st.integers(2, 40))
def test_every_frequent_key_survives(blocks, threshold):
    true, mass = Counter(), 0
    for block in blocks:
        for key, n in block:
            true[key] += n
            mass += n
    summary = MisraGries(mass // threshold + 1)
    for block in blocks:
        one = Counter()
        for key, n in block:
            one[key] += n
        keys = sorted(one)
        summary.add(np.array(keys, np.uint32), np.array([one[k] for k in keys], np.int64))
        summary.merge()
        assert summary.keys.size <= summary.counters
    left = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert summary.off < threshold
    assert all(n - summary.off <= left.get(k, 0) <= n for k, n in true.items())
    assert {k for k, n in true.items() if n >= threshold} <= set(summary.at_least(threshold).tolist())
