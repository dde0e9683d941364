"""From ranked chunks to contexts, prompts, answers, source cards and the report.

A group here is the top k chunks of one question, so aggregates by question stay small.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.functions.text import (
    escape_pipes,
    has_text,
    or_question_mark,
    shorten,
    strip,
)
from narrascope.schema import CATEGORY, NO_CATEGORY_FILTER, PROMPT_TOKENS

# --- Fixed values -----------------------------------------------------------

PROMPT = """You are a financial analyst assistant for {company}. Your task is to answer questions about customer complaints. Use the following retrieved complaint excerpts to formulate your answer. If the context doesn't contain the answer, state that you don't have enough information.

Context:
{context}

Question: {question}

Answer:"""

NO_ANSWER = "I don't have enough information."
NO_QUESTION = "Please enter a question."
NO_SOURCES = "_No sources retrieved._"
NO_REPORT_SOURCES = "(none)"
CARD_BREAK = "\n\n---\n\n"
REPORT_BREAK = "<br>"

REPORT_QUESTIONS = [
    "Why are people unhappy with credit cards?",
    "What are common complaints about personal loans?",
    "What problems do customers report with money transfers?",
    "Are there issues with unauthorized or fraudulent charges?",
    "What complaints relate to savings account fees?",
    "Do customers report difficulty closing their accounts?",
    "What issues do people have with billing disputes?",
    "Are there complaints about poor customer service responses?",
]

# ----------------------------------------------------------------------------

ID = "question_id"
Answerer = Callable[[list[str]], list[str]]


def with_chunk_columns(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits with text and metadata of their chunks, joined after ranking.

    Texts never pass through scoring. Hits that retrieval has proven few carry a
    broadcast hint, so the chunk table is scanned but not shuffled.
    """
    return hits.join(chunks.select(*[c for c in chunks.columns if c != "embedding"]), "chunk_id")


def _joined_by_rank(line: Column, separator: str) -> Column:
    ranked = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return F.array_join(F.transform(ranked, lambda r: r["line"]), separator)


def _tag(separator: str) -> Column:
    return F.concat(
        F.lit("["),
        or_question_mark(F.col(CATEGORY)),
        F.lit(separator),
        or_question_mark(F.col("issue")),
        F.lit("]"),
    )


def within_budget(hits: DataFrame, budget: int, length: Column | None = None) -> DataFrame:
    """The best-ranked hits of each question whose lengths add up to at most ``budget``.

    ``length`` defaults to the characters of the text. Hits are kept whole, but for a first
    hit that alone is longer: its text is cut to its share, so no question loses all it has.
    The question is not counted, so a long context cannot push it out of the prompt.
    """
    ranked = Window.partitionBy(ID).orderBy("rank")
    running = F.sum(F.length("text") if length is None else length).over(
        ranked.rowsBetween(Window.unboundedPreceding, 0)
    )
    over = F.col("used") > budget
    share = F.floor(F.length("text") * F.lit(budget) / F.col("used")).cast("int")
    numbered = hits.withColumns({"used": running, "_place": F.row_number().over(ranked)})
    return (
        numbered.where(~over | (F.col("_place") == 1))
        .withColumn("text", F.when(over, F.substring("text", F.lit(1), share)).otherwise(F.col("text")))
        .withColumn("used", F.least("used", F.lit(budget).cast("long")))
        .drop("_place")
    )


def contexts(hits: DataFrame) -> DataFrame:
    """One numbered, source-tagged context per question that has hits."""
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), _tag(" | "), F.lit(" "), "text")
    return hits.groupBy(ID).agg(_joined_by_rank(line, "\n").alias("context"))


def with_context(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """All questions with their context, empty for a question without hits."""
    joined = questions.join(contexts(hits), ID, "left")
    return joined.withColumn("context", F.coalesce("context", F.lit("")))


def prompt(context: Column, question: Column, company: str = "the company") -> Column:
    """Grounding prompt. Texts may hold any character, so it is put together by ``concat``."""
    head, rest = PROMPT.split("{context}")
    middle, tail = rest.split("{question}")
    return F.concat(
        F.lit(head.replace("{company}", company)), context, F.lit(middle), question, F.lit(tail)
    )


#: Gives the number of tokens of each text; made once per task like an answerer.
Counter = Callable[[list[str]], Sequence[int]]
_WORD = re.compile("[^ \t\n\x0b\f\r]+")


def _longest_fitting(ends: list[int], fits: Callable[[int], bool]) -> int:
    """The last of ``ends`` that fits, or zero; what fits still does with less."""
    low, high = 0, len(ends)
    while low < high:
        middle = (low + high + 1) // 2
        if fits(ends[middle - 1]):
            low = middle
        else:
            high = middle - 1
    return ends[low - 1] if low else 0


def within_tokens(
    context: Column, question: Column, counter: Callable[[], Counter], most_tokens: int, company: str = "the company"
) -> Column:
    """The context, cut behind a whole word so that its prompt has at most ``most_tokens`` tokens.

    The question is never cut; one that leaves no room gets an empty context. A few counts per
    prompt find the place, as more words are taken never to have fewer tokens. A null context
    stays null.
    """
    head, rest = PROMPT.split("{context}")
    middle, tail = rest.split("{question}")
    head = head.replace("{company}", company)

    @F.arrow_udf(T.StringType())
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        count = counter()
        for texts, questions in batches:
            out = []
            for text, asked in zip(texts.to_pylist(), questions.to_pylist()):
                if text is not None:
                    fits = lambda end, t=text, q=asked: count([f"{head}{t[:end]}{middle}{q or ''}{tail}"])[0] <= most_tokens
                    if not fits(len(text)):
                        text = text[: _longest_fitting([m.end() for m in _WORD.finditer(text)], fits)]
                out.append(text)
            yield pa.array(out, pa.string())

    return cut(context, question)


def generate(
    c: Column,
    factory: Callable[[], Answerer],
    batch_size: int = 16,
    most_tokens: int | None = None,
    counter: Callable[[], Counter] | None = None,
) -> Column:
    """Answer of a caller's model to each prompt; a null prompt never reaches the model.

    ``factory()`` runs once per task and returns ``answer(list[str]) -> list[str]``, one
    reply for each prompt; another number of replies is an error. With ``most_tokens`` the model
    is called as ``answer(list[str], most_tokens)``, and with a ``counter`` too a longer reply
    is cut behind a whole word.
    """

    @F.arrow_udf(T.StringType())
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, count = factory(), counter() if counter else None
        for batch in batches:
            prompts = [p for p in batch.to_pylist() if p is not None]
            given = []
            for i in range(0, len(prompts), batch_size):
                asked = prompts[i : i + batch_size]
                answered = list(model(asked) if most_tokens is None else model(asked, most_tokens))
                if len(answered) != len(asked):
                    raise ValueError(f"{len(answered)} replies to {len(asked)} prompts")
                given += [reply.strip() for reply in answered]
            if count is not None and most_tokens is not None:
                for i, (reply, tokens) in enumerate(zip(given, count(given))):
                    if tokens > most_tokens:
                        ends = [m.end() for m in _WORD.finditer(reply)]
                        given[i] = reply[: _longest_fitting(ends, lambda end, r=reply: count([r[:end]])[0] <= most_tokens)]
            replies = iter(given)
            yield pa.array(
                [next(replies) if known else None for known in batch.is_valid().to_pylist()],
                pa.string(),
            )

    return answer(c)


def validated(questions: DataFrame) -> DataFrame:
    """Questions stripped, with ``problem`` set where there is none, and the category to use."""
    asked = strip(F.coalesce("question", F.lit("")))
    return questions.withColumns(
        {
            "question": asked,
            "problem": F.when(~has_text(asked), F.lit(NO_QUESTION)),
            CATEGORY: F.when(
                (F.col(CATEGORY) != NO_CATEGORY_FILTER) & (F.col(CATEGORY) != ""), F.col(CATEGORY)
            ),
        }
    )


def sources(hits: DataFrame) -> DataFrame:
    """The hits of each question as one array in rank order."""
    fields = [c for c in hits.columns if c not in (ID, "rank")]
    return hits.groupBy(ID).agg(
        F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("sources")
    )


def answers(
    questions: DataFrame,
    hits: DataFrame,
    factory: Callable[[], Answerer],
    company: str = "the company",
    tasks: int | None = None,
    counter: Callable[[], Counter] | None = None,
    prompt_tokens: int = PROMPT_TOKENS,
    reply_tokens: int | None = None,
) -> DataFrame:
    """Questions with context and answer, the fixed refusal where nothing was found.

    The model is by far the dearest step: ``tasks`` spreads the questions before it. With a
    ``counter`` of tokens, contexts are cut so that prompts have at most ``prompt_tokens``;
    ``reply_tokens`` is handed to the model.
    """
    asked = questions.join(contexts(hits), ID, "left")
    if tasks:
        asked = asked.repartition(tasks, ID)
    if counter is not None:
        asked = asked.withColumn("context", within_tokens(F.col("context"), F.col("question"), counter, prompt_tokens, company))
    grounded = F.when(
        F.col("context").isNotNull(), prompt(F.col("context"), F.col("question"), company)
    )
    return (
        asked.withColumn("prompt", grounded)
        .withColumn("answer", F.coalesce(generate(F.col("prompt"), factory, most_tokens=reply_tokens, counter=counter), F.lit(NO_ANSWER)))
        .drop("prompt")
    )


def source_cards(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Per question one readable block of its sources, or a note that there are none."""
    card = F.concat(
        F.lit("**Source "),
        F.col("rank").cast("string"),
        F.lit("** — "),
        or_question_mark(F.col(CATEGORY)),
        F.lit(" · "),
        or_question_mark(F.col("issue")),
        F.lit(" · "),
        or_question_mark(F.col("company")),
        F.lit(" ("),
        or_question_mark(F.col("state")),
        F.lit(")\n\n> "),
        "text",
    )
    cards = hits.groupBy(ID).agg(_joined_by_rank(card, CARD_BREAK).alias("cards"))
    return questions.join(cards, ID, "left").withColumn(
        "cards", F.coalesce("cards", F.lit(NO_SOURCES))
    )


def report(answered: DataFrame, hits: DataFrame, n_sources: int = 2) -> DataFrame:
    """Report rows: short answer and best sources, score and comments left to a reader."""
    line = F.concat(_tag(" / "), F.lit(" "), shorten(F.col("text"), 90))
    top = (
        hits.where(F.col("rank") <= n_sources)
        .groupBy(ID)
        .agg(_joined_by_rank(line, REPORT_BREAK).alias("top_sources"))
    )
    return answered.join(top, ID, "left").select(
        F.col(ID).alias("n"),
        "question",
        escape_pipes(shorten(F.col("answer"), 200)).alias("answer"),
        escape_pipes(F.coalesce("top_sources", F.lit(NO_REPORT_SOURCES))).alias("top_sources"),
        F.lit(None).cast("int").alias("score"),
        F.lit(None).cast("string").alias("comments"),
    )
