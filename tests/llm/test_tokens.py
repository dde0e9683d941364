import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from narrascope.functions.bounds import pinned
from narrascope.llm import bpe as bpe_module
from narrascope.llm.bpe import WordEncoder, encode_decode
from narrascope.llm.packing import best_fit, fewest_bins, pack, pack_documents
from narrascope.llm.token_counts import token_counts
from narrascope.llm.token_files import joined_crc, read_token_files, token_index, write_token_files
from narrascope.llm.tokens import TextEncoder
from tests.llm.cases import SCHEMA, awkward, clashing, frame, words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "the", "tion", "É", "İ", "Σ", " ", "  ", "\n", "\t", "\xa0", "\x85", " ", "　", "\x1c", "!", "'s",
       "12", "<|endoftext|>", "<|endof", "text|>", "<|startoftext|>", "日本", "😀", "‍", "᠎", "\r\n", "́"]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(seed, n, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


def rows_for(seed):
    rows = awkward(seed=seed, n=30)
    rng = random.Random(seed)
    return rows + [(100 + i, t) for i, t in enumerate(odd_texts(seed, 40))] + [
        (200, "x" * 3000), (201, "日本" * 900), (202, " ".join(odd_texts(seed, 300))),
        (203, "".join(rng.choice("etaoin") for _ in range(5000)) + "<|endoftext|>" + "Ab" * 3000),
    ]


def test_cut_texts_encode_like_whole_ones():
    encoder, plain = TextEncoder(BYTES), library(BYTES)
    for text in odd_texts(1, 1500):
        assert encoder.ids(text).tolist() == plain(text)
    wordy, plain = WordEncoder(WORDS), library(WORDS)
    for text in odd_texts(2, 1500):
        ids, decoded = wordy.encode(text)
        assert ids.tolist() == plain(text)
        assert decoded == wordy.tokenizer.decode(plain(text), skip_special_tokens=False)


def test_signs_behind_words_are_parts_of_their_own():
    encoder, plain = TextEncoder(BYTES), library(BYTES)
    sent, encode = [], encoder.words.encode_words
    encoder.words.encode_words = lambda words: sent.extend(words) or encode(words)
    for end in ".,;:!?)%$":
        text = f"zebra zebra{end} crossing{end}"
        assert encoder.ids(text).tolist() == plain(text)
    # The library meets each word once, whatever signs follow it.
    assert sent.count(b" zebra") == sent.count(b" crossing") == 1 and len(sent) == 3 + 9
    rng = random.Random(5)
    bits = [*"aZé0_-.,'|<>~\x7f\x1c", " ", " ", "  ", "\n", "<|endoftext|>", "<|endoftext|", "endoftext|>", "'ll", "n't", "ß", "\u200b"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))
        assert encoder.ids(text).tolist() == plain(text), text


@pytest.mark.parametrize("window", [2, 8])
def test_joined_trees_equal_the_whole(monkeypatch, window):
    monkeypatch.setattr(bpe_module, "_WINDOW_TOKENS", window)
    encoder, rng = WordEncoder(WORDS), random.Random(window)
    for _ in range(400):
        alphabet = rng.choice(["ab", "aaaa", "etaoinshrdlu", "ÄÖüé"])
        text = "".join(rng.choice([rng.choice(alphabet), "the", "tion"]) for _ in range(rng.randint(2, 200)))
        piece = encoder.tokenizer.pre_tokenizer.pre_tokenize_str(text.lower())[0][0]
        cut = rng.randint(1, len(piece) - 1)
        left, right = piece[:cut], piece[cut:]
        got = encoder.joined(left, encoder.piece(left), right, encoder.piece(right))
        want = encoder.piece(piece)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_encode_decode(spark, monkeypatch):
    rows = rows_for(3)
    got = encode_decode(clashing(frame(spark, rows)), WORDS).collect()
    plain, tokenizer = library(WORDS), Tokenizer.from_file(WORDS)
    assert sorted(r.row_key for r in got) == sorted(i for i, _ in rows)
    for r in got:
        want = plain(dict(rows)[r.row_key])
        assert r.ids == want and r.decoded == tokenizer.decode(want, skip_special_tokens=False)
    assert encode_decode(spark.createDataFrame([], SCHEMA), WORDS).count() == 0
    with pytest.raises(ValueError):
        encode_decode(frame(spark, rows), BYTES)


@pytest.mark.parametrize("chunk, overlap", [(200, 40), (1 << 16, 1 << 10)])
def test_token_counts(spark, chunk, overlap):
    rows, plain = rows_for(4), library(BYTES)
    got = token_counts(clashing(frame(spark, rows)), BYTES, chunk=chunk, overlap=overlap).collect()
    want = sorted((i, len((t or "").encode()), len(plain(t))) for i, t in rows)
    assert sorted((r.row_key, r.n_bytes, r.n_tokens) for r in got) == want
    repeated = token_counts(frame(spark, [(1, "a b"), (1, "a b"), (None, None)]), BYTES).collect()
    assert sorted(r.n_tokens for r in repeated) == [0, 2, 2]
    assert token_counts(spark.createDataFrame([], SCHEMA), BYTES).count() == 0


def test_token_files(spark, tmp_path):
    rows, plain = rows_for(5), library(BYTES)
    write_token_files(clashing(frame(spark, rows)), BYTES, str(tmp_path / "files"), piece_ids=100)
    got = sorted(token_index(spark, str(tmp_path / "files")).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, (i, text) in zip(got, sorted(rows), strict=True):
        ids = np.array([*plain(text), 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, ids.size, zlib.crc32(ids.tobytes()))
        start += ids.size
    some = read_token_files(spark, str(tmp_path / "files"), [203, 4]).orderBy("doc_id", "piece").collect()
    assert sum((r.ids for r in some), []) == [*plain(dict(rows)[4]), 2, *plain(dict(rows)[203]), 2]
    write_token_files(frame(spark, [(2, "b"), (2, "b c"), (None, None)]), BYTES, str(tmp_path / "odd"))
    got = token_index(spark, str(tmp_path / "odd")).collect()
    assert sorted(r.start for r in got)[0] == 0 and sum(r.n_tokens for r in got) == 6 and len(got) == 3
    write_token_files(spark.createDataFrame([], SCHEMA), BYTES, str(tmp_path / "none"))
    assert token_index(spark, str(tmp_path / "none")).count() == 0


def test_joined_crc():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 50)), rng.randbytes(rng.randint(0, 5000))
        assert joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("seed", range(4))
def test_pack_is_whole_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 300 if seed % 2 else 1023) for _ in range(700)]
    bins = pack(sizes)
    fill = np.bincount(bins, weights=sizes)
    assert len(bins) == len(sizes) and fill.max() <= 1024
    assert fewest_bins(sizes, 1024) <= np.count_nonzero(fill) <= len(best_fit(sizes, 1024))


def test_search_empties_a_bin():
    assert len(best_fit([4, 4, 3, 3, 3, 3], 10)) == 3 and len(set(pack([4, 4, 3, 3, 3, 3], 10).tolist())) == 2
    rng, improved = random.Random(5), 0
    for _ in range(300):
        sizes = [rng.randint(8, 60) for _ in range(24)]
        found = len(set(pack(sizes, 100).tolist()))
        assert found <= len(best_fit(sizes, 100))
        improved += found < len(best_fit(sizes, 100))
    assert improved


def test_pack_documents(spark):
    rows, plain = rows_for(6), library(BYTES)
    got = pack_documents(clashing(frame(spark, rows)), BYTES).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == {i for i, _ in rows}
    for i, text in rows:
        ids = np.array([*plain(text), 2], "<u4")
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == ids.size
        assert all(r.length == 1024 for r in own[1:]) and own[0].length <= 1024
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r.length for r in got) // 1024) + 1
    assert pack_documents(spark.createDataFrame([], SCHEMA), BYTES).count() == 0
    assert len(pack_documents(frame(spark, [(1, "a"), (1, "a"), (None, None)]), BYTES).collect()) == 3


def test_groups_come_together(spark):
    from narrascope.llm.packing import pack_pieces

    rng = random.Random(2)
    sizes = [rng.randint(1, 500) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sizes)], "row long, piece int, length long")
    got = pack_pieces(pieces, group_pieces=200).withColumn("length", F.lit(0)).collect()
    assert len(got) == 3000
    assert len({r.sequence_id for r in got}) <= -(-sum(sizes) // 1024) * 1.01 + 1


def test_levels_end_for_short_equal_texts(spark, monkeypatch):
    from narrascope.llm import packing

    levels = []

    def counted(df, name):
        levels.append(name)
        assert len(levels) < 9, "levels place no pieces"
        return pinned(df, name)

    monkeypatch.setattr(packing, "pinned", counted)
    rows = [(i, "a b") for i in range(10_000)]
    got = pack_documents(frame(spark, rows), BYTES).collect()
    length = got[0].length
    assert len(got) == 10_000 and {r.length for r in got} == {length} and 1 < length < 8 and 1024 % length
    sequences = defaultdict(set)
    for r in got:
        sequences[r.sequence_id].add(r.offset)
    assert sum(map(len, sequences.values())) == 10_000
    assert all(o % length == 0 and o + length <= 1024 for s in sequences.values() for o in s)
    least = -(-10_000 // (1024 // length))
    assert least <= len(sequences) <= least + 2


