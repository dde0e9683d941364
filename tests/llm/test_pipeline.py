import random
from collections import defaultdict

import corpus_pipeline
from narrascope.llm.simhash import fingerprint
from tests.llm.cases import SCHEMA, frame, words
from tests.llm.test_exact_dedup import normal
from tests.llm.test_simhash import roots


def documents(rng):
    passage = words(rng, 60)
    rows = [(0, None), (1, ""), (2, "short text")]
    for i in range(3, 40):
        rows.append((i, words(rng, rng.randint(60, 150))))
    rows += [(50 + i, rows[5 + i][1].replace(" ", "  ")) for i in range(6)]
    rows += [(70 + i, " ".join(w + "###" for w in words(rng, 80).split())) for i in range(8)]
    rows += [(80 + i, f"{words(rng, 70)}\n{passage}\n{words(rng, 70)}") for i in range(5)]
    long = words(rng, 3000)
    rows += [(90, long), (91, long + " end"), (92, words(rng, 60).lower())]
    return rows, passage


def test_stages_equal_brute_force(spark, tmp_path):
    rows, passage = documents(random.Random(6))
    folder = str(tmp_path)
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        left[name] = {r.doc_id: r for r in docs.collect()}

    text = dict(rows)
    good = {i for i, t in rows if len((t or "").split()) >= 50 and "###" not in t}
    assert set(left["quality_rules"]) == good
    first = {}
    for i in sorted(good):
        first.setdefault(normal(text[i]), i)
    assert set(left["exact_dedup"]) == set(first.values())
    prints = {i: fingerprint(text[i]) for i in first.values()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(left["simhash_near_dedup"]) == set(roots(pairs, set(prints)).values())
    assert 91 not in left["simhash_near_dedup"]
    after = left["substring_dedup"]
    assert set(after) == set(left["simhash_near_dedup"])
    assert [i for i, r in after.items() if passage in r.text] == [80]
    assert all(r.text == text[i] for i, r in after.items() if not 80 < i < 85)
    assert all(r.n_chars == len(r.text) for r in after.values())
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = defaultdict(int)
    for r in pieces:
        whole[r.doc_id] += r.length
    assert set(whole) == set(after) and min(whole.values()) > 50


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
