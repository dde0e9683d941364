"""Quality rules combined by weak supervision.

Each rule looks at one side of a text and votes for good, for bad, or abstains. How much a
rule's votes are worth is not set by hand: expectation-maximisation over the votes of the
whole corpus estimates, for a hidden quality, how often each rule votes against good and
against bad texts, and the share of good ones. A document is kept when its posterior
probability of being good is at least one half, whatever single rules said.

The estimate needs only the number of documents for each combination of votes, of which
there are at most 3^10, however large the corpus is.

Defined results: a null or empty text has no words and fails the base rule; every row is
judged, also with a null or repeated id, and equal texts alike; an empty table gives an
empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.llm.common import col, in_slices, keep_rows, keyed, texts_of
from narrascope.llm.text_stats import TextStats, text_stats

MIN_WORDS = 50
#: Rules as (name, quantity, good up to, bad from): in between they abstain. Each usual kind
#: of bad text is seen by at least two of them.
RULES = [
    ("symbols", lambda s: s.n_symbols / s.n_words, 0.05, 0.15),
    ("symbol_words", lambda s: s.n_symbol_words / s.n_words, 0.05, 0.25),
    ("repetition", lambda s: s.n_repeat_words / s.n_words, 0.15, 0.40),
    ("repeated_lines", lambda s: s.n_dup_lines / s.n_lines, 0.10, 0.40),
    ("word_length", lambda s: abs(s.word_chars / s.n_words - 6), 3.0, 6.0),
    ("capitals", lambda s: s.n_upper / max(1, s.n_letters), 0.15, 0.40),
    ("one_word", lambda s: s.n_top_word / s.n_words, 0.12, 0.25),
    ("no_letters", lambda s: s.n_unlike_words / s.n_words, 0.10, 0.25),
    ("marks", lambda s: s.n_marks / s.n_words, 0.05, 0.20),
    ("vocabulary", lambda s: s.n_words / s.n_distinct / (1 + s.n_words / 200) ** 0.5, 2.5, 4.0),
]
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def votes(stats: TextStats) -> list[int]:
    """1 for good, -1 for bad, 0 for none, by each rule; texts without words get none."""
    if not stats.n_words:
        return [0] * len(RULES)
    values = [quantity(stats) for _, quantity, _, _ in RULES]
    return [1 if v <= good else -1 if v >= bad else 0 for v, (_, _, good, bad) in zip(values, RULES)]


def _judged(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [text_stats(text)[0] for text in texts_of(batch.column(1))]
    codes = [sum((v + 1) * 3**i for i, v in enumerate(votes(stats))) for stats in found]
    counts = [pa.array([getattr(stats, name) for stats in found], pa.int64()) for name in _BASE]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), *counts, pa.array(codes, pa.int32())], ["row_key", *_BASE, "votes"]
    )


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each combination; per rule how often a vote is for bad, on
    [bad, good] texts; share of good texts.

    Rules are taken to err independently. A rule mostly knows one kind of bad text and votes
    good on the others, so its rate on bad texts may be low, but never below that on good
    ones, which fixes what is called good. The first guess doubts texts that any rule votes
    against; a few imagined votes keep rules that hardly vote near it.
    """
    cast = np.array([[(code // 3**i) % 3 - 1 for i in range(len(RULES))] for code in codes]).reshape(-1, len(RULES))
    posterior = np.where((cast == -1).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        against = np.empty((len(RULES), 2))
        for side, weight, usual in ((0, counts * (1 - posterior), 0.3), (1, counts * posterior, 0.02)):
            hits = (weight[:, None] * (cast == -1)).sum(axis=0)
            given = (weight[:, None] * (cast != 0)).sum(axis=0)
            against[:, side] = (hits + 10 * usual) / (given + 10)
        against[:, 0] = np.maximum(against[:, 0], against[:, 1])
        good = float((counts @ posterior + 8) / (counts.sum() + 10))
        on_bad, on_good = (
            ((cast == -1) * np.log(against[:, i]) + (cast == 1) * np.log(1 - against[:, i])).sum(axis=1) for i in (0, 1)
        )
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(on_bad - on_good + np.log((1 - good) / good), -500, 500)))
        if np.abs(before - posterior).max(initial=0) < 1e-9:
            break
    return posterior, against, good


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row_key, id, base counts, base_failed, posterior, kept."""
    docs, row = keyed(docs, id_col)
    texts = docs.select(col(row).cast("long").alias("row"), col(text_col).alias("text"))
    schema = "row_key long, " + ", ".join(f"{name} long" for name in _BASE) + ", votes int"
    judged = pinned(in_slices(texts, lambda: _judged, schema, 1), "judged")
    patterns = judged.groupBy("votes").count().toArrow()  # at most 3^10 rows
    codes, counts = patterns["votes"].to_numpy(), patterns["count"].to_numpy().astype(float)
    posterior, _, _ = estimate(codes, counts)
    known = docs.sparkSession.createDataFrame(
        list(zip(codes.tolist(), posterior.tolist())), "votes int, posterior double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = judged.join(F.broadcast(known), "votes").withColumn("base_failed", failed)
    return found.select("row_key", *_BASE, "base_failed", "posterior",
                        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"))


def drop_low_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they are."""
    columns = docs.columns
    rows, row = keyed(docs, id_col)
    kept = quality_rules(rows, row, text_col).filter("kept").select("row_key")
    return keep_rows(rows, row, kept, columns)
