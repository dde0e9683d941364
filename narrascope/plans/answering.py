"""A table of questions to sources, answers and a report, all questions in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned
from narrascope.functions.embedding import Encoder, embed, hashed_words
from narrascope.operators.grounding import (
    REPORT_QUESTIONS,
    Answerer,
    Counter,
    answers,
    report,
    source_cards,
    validated,
    with_chunk_columns,
    within_budget,
)
from narrascope.operators.retrieval import nearest_chunks, nearest_chunks_by_cell
from narrascope.schema import CATEGORY, PROMPT_TOKENS, QUESTION_SCHEMA, TOP_K


def question_table(spark: SparkSession, questions: Sequence[str] = REPORT_QUESTIONS) -> DataFrame:
    """Questions numbered from one, with no category asked for."""
    rows = [(i, q, None) for i, q in enumerate(questions, 1)]
    return spark.createDataFrame(rows, QUESTION_SCHEMA)


def retrieve(
    questions: DataFrame,
    store: DataFrame,
    k: int | None = TOP_K,
    factory: Callable[[], Encoder] = hashed_words,
    centres: np.ndarray | None = None,
    probes: int | None = None,
) -> DataFrame:
    """Ranked chunks with text and metadata for questions that may name a category.

    With ``centres``, of a store opened by ``read_cells``, only the ``probes`` cells
    nearest to a question are searched; without a number, as many as are measured to give a
    recall of 0.9 of the exact search.
    """
    vectors = questions.select(
        "question_id",
        F.col(CATEGORY).alias("wanted"),
        embed(F.col("question"), factory).alias("embedding"),
    )
    if centres is None:
        hits = nearest_chunks(vectors, store, k, question_category="wanted")
    else:
        hits = nearest_chunks_by_cell(vectors, store, centres, k, probes, question_category="wanted")
    return with_chunk_columns(hits, store)


def answer_questions(
    questions: DataFrame,
    store: DataFrame,
    answerer: Callable[[], Answerer],
    *,
    k: int | None = TOP_K,
    factory: Callable[[], Encoder] = hashed_words,
    company: str = "the company",
    tasks: int | None = None,
    budget: int | None = None,
    centres: np.ndarray | None = None,
    probes: int | None = None,
    counter: Callable[[], Counter] | None = None,
    prompt_tokens: int = PROMPT_TOKENS,
    reply_tokens: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Answers and the hits they rest on. Blank questions are answered with a request.

    At most ``budget`` characters of chunk text go into a prompt where a budget is given. With a
    ``counter`` of the model's tokens, contexts are cut so that a prompt has at most
    ``prompt_tokens``; ``reply_tokens`` caps the reply.
    """
    checked = validated(questions)
    good = checked.where("problem IS NULL").drop("problem")
    found = retrieve(good, store, k, factory, centres, probes)
    if budget is not None:
        found = within_budget(found, budget).drop("used")
    hits = pinned(found, "hits")
    answered = answers(good, hits, answerer, company, tasks, counter, prompt_tokens, reply_tokens)
    rejected = checked.where("problem IS NOT NULL").select(
        *good.columns, F.lit(None).cast("string").alias("context"), F.col("problem").alias("answer")
    )
    return answered.select(*good.columns, "context", "answer").unionByName(rejected), hits


def answer_with_cards(
    questions: DataFrame, store: DataFrame, answerer: Callable[[], Answerer], **options
) -> DataFrame:
    """What a chat page shows: question, answer and readable sources."""
    answered, hits = answer_questions(questions, store, answerer, **options)
    return source_cards(answered, hits)


def evaluate(
    questions: DataFrame, store: DataFrame, answerer: Callable[[], Answerer], **options
) -> DataFrame:
    """Report rows for a question table."""
    answered, hits = answer_questions(questions, store, answerer, **options)
    return report(answered, hits)


def save_report(rows: DataFrame, path: str) -> str:
    rows.write.mode("overwrite").parquet(path)
    return path
