"""The registered queries on a table with nulls, empty and repeated texts, repeated and null ids and
clashing columns, against the libraries and plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from narrascope.llm import queries
from tests.llm.cases import awkward, clashing, frame, words
from tests.llm.test_simhash import roots, slow_print

WHITE = "\x20\x09-\x0d"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    plain = awkward(seed=6, n=36)
    return [*plain, plain[20], (21, words(rng, 70)), (None, words(rng, 60)), (None, None), (500, "<|endoftext|> x")]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("contracts"))
    clashing(frame(spark, rows)).write.parquet(f"{path}/documents.parquet")
    return path


def library(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids, tokenizer


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op4(spark, folder, rows):
    encode, _ = library("byte_bpe_50k.json")
    found = queries.op4_best_fit_packing(spark, folder).collect()
    want = Counter()
    for ident, text in rows:
        ids = encode(text) + [2]
        first = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        edges = [0, *range(first, len(ids), 1024), len(ids)] if len(ids) > first else [0, len(ids)]
        want.update((ident, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = [0, *np.cumsum([length for _, length in sorted(places)]).tolist()]
        assert [offset for offset, _ in sorted(places)] == ends[:-1] and ends[-1] <= 1024
    assert len(sequences) <= -(-sum(r.length for r in found) // 1024) + 1


def test_op5_and_op6(spark, folder, rows):
    encode, _ = library("byte_bpe_50k.json")
    found = queries.op5_token_counts(spark, folder).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        (i, len((t or "").encode()), n := len(encode(t)), n > 512) for i, t in rows
    )
    encode, tokenizer = library("word_bpe_49k.json")
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = queries.op6_bpe_encode_decode(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == Counter(
        (i, len(ids := encode(t)), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False)))
        for i, t in rows
    )


def test_op7(spark, folder, rows):
    want = Counter()
    for ident, text in rows:
        found = re.findall(f"[^{WHITE}]+", text or "")
        windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
        inside = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
        seen, again = set(), 0
        for line in (text or "").split("\n"):
            again += bool(re.search(f"[^{WHITE}]", line)) and line in seen
            seen.add(line)
        failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
        signs = sum((text or "").count(c) for c in "#*$%&|<>")
        want[(ident, len(found), sum(map(len, found)), signs, again, len(inside), failed)] += 1
    got = queries.op7_quality_rules(spark, folder).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_op9(spark, folder, rows):
    prints = [slow_print(t or "") for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots(pairs, range(len(rows)))
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[root[i]] = min(ident, least.get(root[i], ident))
    got = queries.op9_simhash_near_dedup(spark, folder).collect()
    want = Counter((ident, f"{prints[i]:016x}", least.get(root[i])) for i, (ident, _) in enumerate(rows))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_op10(spark, folder, rows):
    encode, _ = library("byte_bpe_50k.json")
    got = sorted(queries.op10_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(ids := encode(t) + [2]), crc(ids)) for i, t in rows
    )
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)


def test_pipeline_of_awkward_tables(spark, folder, rows):
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert pieces and {r.doc_id for r in pieces} <= {i for i, _ in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
        left = Counter(r.doc_id for r in out.select("doc_id").collect())
        assert not left - Counter(i for i, _ in rows), name
    # Of equal texts under equal or null ids one row stays.
    kept = corpus_pipeline.exact_stage(spark, docs, folder).select("text").collect()
    normal = lambda t: re.sub(f"[{WHITE}]+", " ", t or "")
    assert Counter(normal(r.text) for r in kept) == Counter({normal(t): 1 for _, t in rows})
