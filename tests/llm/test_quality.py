import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrascope.llm.classifier import BUCKETS, fit, score_documents, train_classifier
from narrascope.llm.quality_rules import RULES, drop_low_quality, estimate, quality_rules, votes
from narrascope.llm.text_stats import text_stats
from tests.llm.cases import SCHEMA, awkward, clashing, frame, words

WHITE = " \t\n\x0b\x0c\r"


def slow_counts(text):
    text = text or ""
    bare = text
    for w in WHITE[1:]:
        bare = bare.replace(w, " ")
    found = [w for w in bare.split(" ") if w]
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {i + k for i, w in enumerate(zip(found, found[1:], found[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def sample(rng, kind):
    text = words(rng, rng.randint(60, 200))
    if kind == "symbols":
        return " ".join(w + rng.choice(["###", "$$$"]) for w in text.split())
    if kind == "shout":
        return " ".join(w.upper() + "!!" for w in text.split())
    if kind == "words":
        return " ".join(w for w in text.split()[:8] for _ in range(20))
    return text


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    kinds = ["symbols", "shout", "words"] + ["good"] * 12
    rows = [(i, kinds[i % 15]) for i in range(450)]
    return [(i, sample(rng, kind), kind) for i, kind in rows]


def test_base_counts(spark):
    rows = awkward(seed=2, n=40) + [(90, "a b c a b c a"), (91, "x\n x\nx\n\n \n"), (92, "# *|é é\x1c é")]
    got = quality_rules(clashing(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert base == slow_counts(dict(rows)[r.row_key])
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert r.base_failed == failed and r.kept == (not failed and r.posterior >= 0.5)


def test_rules_agree_on_bad_texts(spark, corpus):
    got = quality_rules(frame(spark, [(i, t) for i, t, _ in corpus])).collect()
    kept = {r.row_key: r.kept for r in got}
    assert all(kept[i] == (kind == "good") for i, _, kind in corpus)
    docs = frame(spark, [(i, t) for i, t, _ in corpus])
    left = drop_low_quality(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, k in kept.items() if k}


def slow_estimate(rows, rounds):
    """Document by document instead of by combination."""
    cast = [[(c // 3**i) % 3 - 1 for i in range(len(RULES))] for c in rows]
    posterior = [0.1 if -1 in v else 0.95 for v in cast]
    for _ in range(rounds):
        rates = []
        for j in range(len(RULES)):
            rate = []
            for usual, weight in ((0.3, [1 - p for p in posterior]), (0.02, posterior)):
                hits = sum(w for w, v in zip(weight, cast) if v[j] == -1)
                given = sum(w for w, v in zip(weight, cast) if v[j])
                rate.append((hits + 10 * usual) / (given + 10))
            rates.append((max(rate), rate[1]))
        good = (sum(posterior) + 8) / (len(cast) + 10)
        posterior = []
        for v in cast:
            bad_odds, good_odds = 1 - good, good
            for j, vote in enumerate(v):
                if vote:
                    bad_odds *= rates[j][0] if vote < 0 else 1 - rates[j][0]
                    good_odds *= rates[j][1] if vote < 0 else 1 - rates[j][1]
            posterior.append(good_odds / (good_odds + bad_odds))
    return posterior


def test_estimate_equals_document_by_document():
    rng = random.Random(1)
    rows = [sum((rng.choice([0, 1, 2, 2, 2])) * 3**i for i in range(len(RULES))) for _ in range(120)]
    codes, counts = np.unique(rows, return_counts=True)
    posterior, _, _ = estimate(codes, counts.astype(float), rounds=5)
    by_code = dict(zip(codes.tolist(), posterior.tolist()))
    assert np.allclose([by_code[c] for c in rows], slow_estimate(rows, 5))


def test_rules_on_nulls_repeated_rows_and_empty_table(spark):
    got = quality_rules(frame(spark, [(1, None), (1, None), (None, "a b")])).collect()
    assert [r.base_failed for r in got] == [True] * 3 and not any(r.kept for r in got)
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
    assert drop_low_quality(spark.createDataFrame([], SCHEMA)).count() == 0
    assert votes(text_stats("")[0]) == [0] * len(RULES)


def labelled(spark, corpus):
    rows = [(i, int(kind == "good"), 0) for i, _, kind in corpus if i % 7] + [(3, None, 1), (None, 1, 1), (99999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs = clashing(frame(spark, [(i, t) for i, t, _ in corpus] + [(1000, None), (1001, "")]))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    machine = train_classifier(docs, labelled(spark, corpus), usable=fold != 0)
    got = {r.row_key: r.score for r in score_documents(docs, machine).collect()}
    held = {r.doc_id for r in docs.filter(fold == 0).collect()}
    right = [(got[i] >= 0.5) == (kind == "good") for i, _, kind in corpus if i in held]
    assert len(got) == len(corpus) + 2 and np.mean(right) > 0.95
    assert all(0 <= s <= 1 for s in got.values())
    again = train_classifier(docs, labelled(spark, corpus), usable=fold != 0)
    assert np.array_equal(again.factors, machine.factors)


def test_pairs_are_scored_as_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 5])
    buckets = np.concatenate([rng.choice(BUCKETS, n, replace=False) for n in sizes])
    weights, dense = rng.random(8), rng.random((2, 4))
    machine = fit(buckets, weights, dense, sizes, np.array([0.0, 1.0]), epochs=3)
    features, values, rows = machine.sparse(buckets, weights, dense, sizes)
    margins, _ = machine.margins(features, values, rows, 2)
    for row in (0, 1):
        mine = [(f, v) for f, v, r in zip(features, values, rows) if r == row]
        want = machine.bias + sum(machine.linear[f] * v for f, v in mine)
        for (f, v), (g, w) in product(mine, mine):
            if f < g:
                want += machine.factors[f] @ machine.factors[g] * v * w
        assert np.isclose(margins[row], want)


def test_classifier_without_labels_or_rows(spark, corpus):
    docs, none = frame(spark, [(1, "a b"), (1, "a b"), (None, None)]), labelled(spark, []).filter("false")
    scores = [r.score for r in score_documents(docs, train_classifier(docs, none)).collect()]
    assert scores == [0.5] * 3
    empty = spark.createDataFrame([], SCHEMA)
    assert score_documents(empty, train_classifier(empty, labelled(spark, corpus))).count() == 0
