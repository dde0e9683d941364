"""Exact token ids of whole texts, with the words met so far remembered.

A byte-level BPE tokenizer never lets a token reach from a character that is not white
space to white space behind it: its split pattern ends every word and every run of signs
there, and the special strings hold no white space. So a text can be cut in front of any
white space that follows something else, and between an ASCII letter and another ASCII sign
outside of the special strings, each part encoded alone and the ids be joined.
Parts are mostly single words. Those of a batch are found and numbered as whole columns,
each different one is encoded once, and a worker remembers the common ones.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Unicode's White_Space.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_EDGE = re.compile(f"[^{_WHITE}](?=[{_WHITE}])")
_ASCII_WHITE = frozenset(b"\t\n\x0b\f\r ")
_AT_ONCE = 256
_REMEMBERED_WORDS, _REMEMBERED_CHARS = 1 << 18, 1 << 22


def load_tokenizer(path: str):
    """The tokenizer of a file, without the truncation and padding it may ask for."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def is_byte_level(tokenizer) -> bool:
    """Whether texts may be cut in front of white space (see above)."""
    told = json.loads(tokenizer.to_str())
    before = told["pre_tokenizer"] or {}
    plain = all(
        not (token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"])
        and not re.search(f"[{_WHITE}]", token["content"])
        for token in told["added_tokens"]
    )
    return bool(
        plain and told["normalizer"] is None and told["model"]["type"] == "BPE"
        and before.get("type") == "ByteLevel" and before.get("use_regex")
        and not before.get("add_prefix_space")
    )


def _ends_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII ends in front of places whose last byte is not ASCII."""
    first, second, last = (data[np.maximum(at - back, 0)] for back in (3, 2, 1))
    wide = (second == 0x80) & ((last <= 0x8A) | np.isin(last, (0xA8, 0xA9, 0xAF)))
    return (
        ((second == 0xC2) & np.isin(last, (0x85, 0xA0)))
        | ((first == 0xE1) & (second == 0x9A) & (last == 0x80))
        | ((first == 0xE2) & (wide | ((second == 0x81) & (last == 0x9F))))
        | ((first == 0xE3) & (second == 0x80) & (last == 0x80))
    )


def _part_starts(data: np.ndarray, text_starts: np.ndarray, uncut: list[bytes]) -> np.ndarray:
    """Where parts begin: with each text, in front of ASCII white space behind another sign, and
    in front of another ASCII sign behind an ASCII letter unless within one of the ``uncut``."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    letter = ((data | 32) - np.uint8(97)) < 26
    first = np.zeros(data.size, bool)
    first[1:] = letter[:-1] & ~letter[1:] & (data[1:] > 32) & (data[1:] < 127)
    whole = data.tobytes() if uncut else b""
    for string in uncut:
        at = whole.find(string)
        while at >= 0:
            first[at + 1 : at + len(string)] = False
            at = whole.find(string, at + 1)
    first[1:] |= white[1:] & ~white[:-1]
    at = np.flatnonzero(first[1:] & (data[:-1] >= 0x80)) + 1
    first[at[_ends_white(data, at)]] = False
    first[text_starts[text_starts < data.size]] = True
    return np.flatnonzero(first)


class Remembered(dict):
    """Word to encoded form, in two generations.

    When the young one is full it becomes the old one, and what is met again comes over, so
    common words stay and rare ones go.
    """

    def __init__(self, encode_words, most: int = _REMEMBERED_WORDS):
        super().__init__()
        self.encode_words, self.most, self.old, self.chars = encode_words, most, {}, 0

    def of(self, words: list[bytes]) -> list[bytes]:
        """The encoded form of each of ``words``, which differ from each other."""
        if len(self) > self.most or self.chars > _REMEMBERED_CHARS:
            self.old, self.chars = dict(self), 0
            self.clear()
        found = list(map(self.get, words))
        missing = [at for at, form in enumerate(found) if form is None]
        if self.old and missing:
            forms = list(map(self.old.get, [words[at] for at in missing]))
            back = [(at, form) for at, form in zip(missing, forms) if form is not None]
            missing = [at for at, form in zip(missing, forms) if form is None]
            self._keep(found, words, back)
        if missing:
            new = [words[at] for at in missing]
            self._keep(found, words, zip(missing, self.encode_words(new)))
            self.chars += sum(map(len, new))
        return found

    def _keep(self, found: list, words: list[bytes], forms) -> None:
        for at, form in forms:
            found[at] = self[words[at]] = form


class TextEncoder:
    """Ids as the tokenizers library gives them, without added special tokens."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.cuttable = is_byte_level(self.tokenizer)
        added = self.tokenizer.get_added_tokens_decoder() if self.cuttable else {}
        self.uncut = [token.content.encode() for token in added.values()]
        self.mark, self.mark_id = min(((t.content, i) for i, t in added.items()), default=(None, None))
        self.sizes = self._sizes() if self.cuttable else None
        self.words = Remembered(self._encode_words)

    def _sizes(self) -> np.ndarray:
        """How many bytes each id stands for; a byte-level vocabulary writes a byte as one character."""
        added = self.tokenizer.get_added_tokens_decoder()
        ids = range(1 + max([*self.tokenizer.get_vocab(with_added_tokens=True).values(), 0]))
        names = [added[i].content.encode() if i in added else self.tokenizer.id_to_token(i) or "" for i in ids]
        return np.array([len(name) for name in names], np.int64)

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word.

        Words that begin with white space and do not end with it can follow each other as in
        a text. Many go at a time, and the bytes of their tokens tell them apart.
        """
        if self.sizes is None:
            return self._encode_apart(words)
        places: tuple[list[int], list[int]] = [], []
        for at, word in enumerate(words):
            places[word[0] in _ASCII_WHITE and not word.decode()[-1].isspace()].append(at)
        apart, plain = places
        out: list[bytes] = [b""] * len(words)
        for first in range(0, len(plain), _AT_ONCE):
            some = plain[first : first + _AT_ONCE]
            forms = self._encode_joined([words[at] for at in some])
            if forms is None:
                apart += some
                continue
            for at, form in zip(some, forms):
                out[at] = form
        for at, form in zip(apart, self._encode_apart([words[at] for at in apart])):
            out[at] = form
        return out

    def _encode_joined(self, words: list[bytes]) -> list[bytes] | None:
        """The packed ids of words that follow each other, or nothing where a token crosses."""
        text = b"".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(word) for word in words])
        last = np.searchsorted(ends, wanted)
        if not ids.size or last[-1] != ids.size - 1 or (ends[last] != wanted).any():
            return None
        edges, packed = [0, *(4 * (last + 1)).tolist()], ids.tobytes()
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def _encode_apart(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of any words.

        The library encodes what lies between special strings on its own, so many words go
        at a time with one of those strings between them.
        """
        words = [word.decode() for word in words]
        if self.mark is None or any(self.mark in word for word in words):
            found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            return [np.array(one.ids, "<u4").tobytes() for one in found]
        out = []
        for at in range(0, len(words), _AT_ONCE):
            text = self.mark.join(words[at : at + _AT_ONCE])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            starts, ends = (4 * np.r_[0, marks + 1]).tolist(), (4 * np.r_[marks, ids.size]).tolist()
            packed = ids.tobytes()
            out += [packed[a:b] for a, b in zip(starts, ends)]
        return out

    def _starts(self, data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        return _part_starts(data, text_starts, self.uncut)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has; null as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        if not self.cuttable:
            parts = self._encode_words(texts.to_pylist())
            return np.frombuffer(b"".join(parts), "<u4"), np.array([len(p) // 4 for p in parts], np.int64)
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or edges[0] == edges[-1]:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        starts = self._starts(data, edges[:-1])
        places = pa.py_buffer(np.r_[starts, data.size].astype(np.int32))
        parts = pa.Array.from_buffers(pa.binary(), starts.size, [None, places, pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        packed = self.words.of(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(packed), "<u4")
        kind = np.int32 if data.size < 1 << 29 else np.int64
        sizes = np.fromiter(map(len, packed), kind, len(packed)) // 4
        which = parts.indices.to_numpy()
        counts = sizes[which]
        ends = np.cumsum(counts, dtype=kind)
        # Of each id its place among those of the different words.
        shift = (np.cumsum(sizes, dtype=kind) - sizes)[which] - (ends - counts)
        flat = ids[np.repeat(shift, counts) + np.arange(ends[-1], dtype=shift.dtype)]
        before = np.r_[kind(0), ends][np.searchsorted(starts, edges)]
        return flat, np.diff(before).astype(np.int64)

    def ids(self, text: str) -> np.ndarray:
        return self.encode(pa.array([text], pa.string()))[0]


@cache
def text_encoder(path: str) -> TextEncoder:
    """The encoder of a file, kept by a worker from task to task."""
    return TextEncoder(path)
