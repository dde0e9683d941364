import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrascope.llm import alignment, queries
from narrascope.llm.alignment import align_tokenizers, common_ends, path_cuts
from tests.llm.cases import awkward, clashing, frame, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "<|endoftext|> and <s> or </s> <unk>", "a  b   c    \n\n  d \t e ", "one ▁ two", "▁", " ", "  ", "\n", "x" * 300,
    "名前は 𝔘𝔫𝔦 é é ﬁ ① \x00 ​ \xa0 　 ok", "trailing space ", "don't  we'll 12345 <0x41> ###", "<|endoftext|>",
    " leading", " mixed white ", "tab\tsep  \r\n end",
]


def brute_force(rows):
    """Per row the contract's columns, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    of_char = alignment._byte_characters()
    out, links = [], []
    for _, text in rows:
        a, b, a_bytes, b_bytes = [], [], [], []
        whole = (" " + (text or "")).encode()
        if text:
            found = tokenizer.encode(" " + text, add_special_tokens=False)
            a, a_bytes = found.ids, [bytes(of_char[c] for c in tokenizer.id_to_token(i)) for i in found.ids]
            b = model.encode(text)
            b_bytes = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes))
        common = sorted(set(a_ends) & set(b_ends))
        groups, pairs, i, j = [], [], 0, 0
        for end in common:
            p, q = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
            pairs.append((a[p - 1], b[q - 1]))
        out.append((len(a), len(b), ";".join(groups), len(common)))
        links.append(pairs)
    count = Counter(pair for one in links for pair in one)
    most = Counter()
    for (x, y), n in count.items():
        most[y] = max(most[y], n)
    return [
        (n_a, n_b, n, n, sum(count[p] == most[p[1]] for p in mine), sum(count[p] for p in mine), groups)
        for (n_a, n_b, groups, n), mine in zip(out, links)
    ], count


@pytest.mark.parametrize("piece_ends", [1 << 16, 64, 3])
def test_equals_brute_force(spark, piece_ends):
    rng = random.Random(3)
    rows = awkward(5) + [(100 + i, t) for i, t in enumerate(ODD)] + [(300, words(rng, 400) + "é" * 40), (301, words(rng, 500))]
    found, corpus = align_tokenizers(clashing(frame(spark, rows)), A, B, piece_ends=piece_ends)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    got = {r.row_key: tuple(r[n] for n in names) for r in found.collect()}
    want, count = brute_force(rows)
    assert got == dict(zip([i for i, _ in rows], want))
    assert {(r.a_id, r.b_id): r["count"] for r in corpus.collect()} == dict(count)


def test_workers_divide_large_documents(spark):
    """A document of several pieces, in workers that have the module as it is."""
    rng = random.Random(9)
    text = words(rng, 30_000) + "ü" * 5000
    rows = [(1, text), (2, text[:1000]), (3, text)]
    found, _ = align_tokenizers(frame(spark, rows), A, B)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want, _ = brute_force(rows)
    assert want[0][0] + want[0][1] > alignment.PIECE_ENDS
    assert {r.row_key: tuple(r[n] for n in names) for r in found.collect()} == dict(zip([1, 2, 3], want))


def test_query_with_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, "some words here"), (1, "some words here"), (None, "others"), (2, None), (3, "")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_tokenizer_alignment(spark, str(tmp_path)).collect()
    want, _ = brute_force(rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    assert Counter((r.doc_id, r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in found) == Counter(
        (i, w[0], w[3], w[5], digest(w[6])) for (i, _), w in zip(rows, want)
    )


def test_empty_table(spark):
    found, corpus = align_tokenizers(frame(spark, []), A, B)
    assert found.count() == 0 and corpus.count() == 0


ENDS = st.lists(st.integers(1, 4), max_size=60).map(lambda steps: np.cumsum(np.array(steps, np.int64)))


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS, st.integers(1, 20))
def test_pieces_are_even_and_lose_nothing(a, b, most):
    i, j = path_cuts(a, b, most)
    work = np.diff(i) + np.diff(j)
    assert (work <= most + 1).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
    found = [common_ends(a[p:q], b[r:s]) for p, q, r, s in zip(i, i[1:], j, j[1:])]
    ends = np.concatenate([a[p:q][f[0]] for f, p, q in zip(found, i, i[1:])])
    assert ends.tolist() == sorted(set(a.tolist()) & set(b.tolist()))
