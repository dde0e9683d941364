"""Counts over one text, shared by the quality rules and the classifier."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np

from narrascope.llm.common import SPACES, word_blocks

SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = b"0123456789"
_WORDLIKE = re.compile(rb"[A-Za-z\x80-\xff]")
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS).encode() + b"]")
_ENDS = (".", "!", "?", '"', "'", ":", ";", ")")


@dataclass
class TextStats:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int  # with a word
    n_ended_lines: int
    n_distinct: int
    n_top_word: int
    n_unlike_words: int
    n_symbol_words: int
    n_letters: int
    n_upper: int
    n_digits: int
    n_marks: int


def _repeated(ids: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of three that occurs more than once."""
    if ids.size < 4:
        return 0
    _, pair = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
    _, which, count = np.unique(pair[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)
    often = count[which] > 1
    covered = np.zeros(ids.size, bool)
    for shift in range(3):
        covered[shift : ids.size - 2 + shift] |= often
    return int(covered.sum())


def text_stats(text: str) -> tuple[TextStats, dict[bytes, int], np.ndarray]:
    """The counts, a number for each different word, and the words in order as numbers."""
    data = text.encode()
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in word_blocks(data, 0)]
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    counts = np.bincount(ids, minlength=len(numbers))

    seen, lines, dup, ended = set(), 0, 0, 0
    for line in text.split("\n"):
        bare = line.strip(SPACES)
        if bare:
            lines += 1
            dup += line in seen
            ended += bare.endswith(_ENDS)
            seen.add(line)

    size = len(data)
    unlike = [i for word, i in numbers.items() if not _WORDLIKE.search(word)]
    marked = [i for word, i in numbers.items() if _SYMBOL.search(word)]
    found = TextStats(
        n_words=ids.size,
        word_chars=len(text) - sum(map(text.count, SPACES)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=dup,
        n_repeat_words=_repeated(ids, len(numbers)),
        n_lines=lines,
        n_ended_lines=ended,
        n_distinct=len(numbers),
        n_top_word=int(counts.max()) if ids.size else 0,
        n_unlike_words=int(counts[unlike].sum()),
        n_symbol_words=int(counts[marked].sum()),
        n_letters=size - len(data.translate(None, _LETTERS)),
        n_upper=size - len(data.translate(None, _UPPER)),
        n_digits=size - len(data.translate(None, _DIGITS)),
        n_marks=data.count(b"!") + data.count(b"?"),
    )
    numbers.default_factory = None
    return found, numbers, ids
