import re

import pytest
from pyspark.sql import functions as F

from narrascope.functions.embedding import hashed_words
from narrascope.operators import grounding as G
from narrascope.plans import answering
from narrascope.schema import CATEGORY, QUESTION_SCHEMA
from narrascope.sources import chunk_store

HIT = f"question_id long, rank int, chunk_id string, distance double, text string, {CATEGORY} string, issue string, company string, state string"


@pytest.fixture
def hits(spark):
    return spark.createDataFrame(
        [
            (1, 2, "b", 0.2, "interest too high", "Credit Card", "Interest", "Acme", ""),
            (1, 1, "a", 0.1, "late fee charged", "Credit Card", "Fees", None, "CA"),
            (2, 1, "c", 0.3, "100% of {question} | " + "y" * 100, None, "Fees", "A|B", "NY"),
        ],
        HIT,
    ).repartition(3)


def questions(spark, *rows):
    return spark.createDataFrame(list(rows), QUESTION_SCHEMA)


def test_context(spark, hits):
    found = {r.question_id: r.context for r in G.contexts(hits).collect()}
    assert found[1] == (
        "1. [Credit Card | Fees] late fee charged\n2. [Credit Card | Interest] interest too high"
    )
    assert found[2].startswith("1. [? | Fees] 100%")
    empty = G.with_context(questions(spark, (7, "why?", None)), hits).first()
    assert empty.context == ""


def test_prompt(spark):
    row = spark.range(1).select(
        G.prompt(F.lit("some context {question} %s"), F.lit("why?"), "Acme").alias("p")
    ).first()
    assert "some context {question} %s\n\nQuestion: why?" in row.p
    assert "don't have enough information" in row.p and "for Acme." in row.p
    assert row.p.endswith("Answer:")


def test_budget_keeps_whole_hits_and_cuts_a_long_first_one(hits):
    kept = {(r.question_id, r["rank"]): r for r in G.within_budget(hits, 20).collect()}
    assert set(kept) == {(1, 1), (2, 1)}
    assert kept[1, 1].text == "late fee charged" and kept[1, 1].used == 16
    assert kept[2, 1].text == "100% of {question} |" and kept[2, 1].used == 20


def test_another_number_of_replies_is_an_error(spark, hits):
    asked = questions(spark, (1, "fees?", None), (2, "why?", None)).coalesce(1)
    with pytest.raises(Exception, match="replies to"):
        G.answers(asked, hits, lambda: lambda prompts: prompts + ["more"]).collect()


def test_answers_fall_back_without_calling_the_model(spark, hits):
    asked = questions(spark, (1, "fees?", None), (3, "nothing?", None))

    def model():
        def answer(prompts):
            assert all("fees?" in p for p in prompts)
            return ["  fine  " for _ in prompts]

        return answer

    found = {r.question_id: r.answer for r in G.answers(asked, hits, model, tasks=2).collect()}
    assert found == {1: "fine", 3: "I don't have enough information."}


def test_validation(spark):
    asked = questions(spark, (1, " why? ", "All products"), (2, "\n　", None), (3, None, ""), (4, "x", "Credit Card"))
    found = {r.question_id: (r.question, r.problem, r[CATEGORY]) for r in G.validated(asked).collect()}
    message = "Please enter a question."
    assert found == {
        1: ("why?", None, None), 2: ("", message, None), 3: ("", message, None), 4: ("x", None, "Credit Card"),
    }


def test_cards_and_report(spark, hits):
    asked = questions(spark, (1, "q1", None), (2, "q2", None), (3, "q3", None)).withColumn("answer", F.lit("a | b"))
    cards = {r.question_id: r.cards for r in G.source_cards(asked, hits).collect()}
    assert cards[1] == (
        "**Source 1** — Credit Card · Fees · ? (CA)\n\n> late fee charged\n\n---\n\n"
        "**Source 2** — Credit Card · Interest · Acme ()\n\n> interest too high"
    )
    assert cards[3] == "_No sources retrieved._"
    report = {r.n: r for r in G.report(asked, hits).collect()}
    assert report[1].answer == "a \\| b" and report[1].score is None and report[1].comments is None
    assert report[1].top_sources == (
        "[Credit Card / Fees] late fee charged<br>[Credit Card / Interest] interest too high"
    )
    assert report[2].top_sources.startswith("[? / Fees] 100% of {question} \\| y") and report[2].top_sources.endswith("…")
    assert report[3].top_sources == "(none)"
    best = {r.question_id: [s.chunk_id for s in r.sources] for r in G.sources(hits).collect()}
    assert best == {1: ["a", "b"], 2: ["c"]}


def test_whole_flow(spark, tmp_path):
    schema = chunk_store.STORE_SCHEMA
    rows = [
        ("1-0", "late fee on my card", "1", "Credit Card", "", "Fees", "", "", "", "", 0, 1),
        ("2-0", "loan interest is high", "2", "Personal Loan", "", "Interest", "", "", "", "", 0, 1),
        ("3-0", "no label here fee", "3", "", "", "Other", "", "", "", "", 0, 1),
    ]
    chunks = spark.createDataFrame(rows, schema.fieldNames()[:-1]).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields[:-1]]
    )
    path = str(tmp_path / "store")
    assert chunk_store.write_store(chunks, path) == 3
    store = chunk_store.read_store(spark, path)
    assert sorted(r[CATEGORY] for r in store.collect()) == ["", "Credit Card", "Personal Loan"]
    assert chunk_store.check_dimension(store, 384).count() == 0
    assert chunk_store.open_store(spark, path).count() == 3
    with pytest.raises(ValueError, match="written by encoder"):
        chunk_store.open_store(spark, path, lambda: hashed_words(8))
    asked = questions(
        spark, (1, "late fee", None), (2, "fee", "Personal Loan"), (3, "fee", "Mortgage"), (4, " ", None)
    )

    def model():
        return lambda prompts: [p.split("\n")[3] for p in prompts]

    found = {r.question_id: r for r in answering.answer_with_cards(asked, store, model, k=1).collect()}
    assert found[1].answer == "1. [Credit Card | Fees] late fee on my card"
    assert found[2].answer == "1. [Personal Loan | Interest] loan interest is high"
    assert found[3].answer == G.NO_ANSWER and found[3].cards == G.NO_SOURCES
    assert found[4].answer == G.NO_QUESTION and found[4].cards == G.NO_SOURCES
    with pytest.raises(ValueError, match="more than once"):
        chunk_store.write_store(chunks.unionByName(chunks), path)
    assert chunk_store.read_store(spark, path).count() == 3  # as it was
    with pytest.raises(ValueError, match="more than once"):
        chunk_store.join_vectors(chunks, chunk_store.with_embeddings(chunks.unionByName(chunks)))


def test_default_questions_and_foreign_store(spark, tmp_path):
    assert answering.question_table(spark).count() == 8
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="missing columns"):
        chunk_store.read_prebuilt(spark, str(tmp_path / "other"))


def two_characters():
    return lambda texts: [sum((len(w) + 1) // 2 for w in t.split()) for t in texts]


@pytest.mark.parametrize("most", [40, 70, 75, 90, 1000])
def test_contexts_are_cut_to_tokens(spark, most):
    context = "1. [x | y] some words of a  first chunk\n2. [é] more\twords, the end "
    rows = spark.createDataFrame([(1, context, "Why?"), (2, "", "Why?"), (3, None, "q"), (4, context, "long " * 40)], "id int, context string, question string")
    cut = G.within_tokens(F.col("context"), F.col("question"), two_characters, most)
    found = {r.id: r.cut for r in rows.select("id", cut.alias("cut")).collect()}
    assert found[3] is None and found[2] == ""

    def tokens(text, question):
        prompt = G.PROMPT.replace("{company}", "the company").replace("{context}", text).replace("{question}", question)
        return two_characters()([prompt])[0]

    for ident, question in ((1, "Why?"), (4, "long " * 40)):
        ends = [m.end() for m in re.finditer(r"\S+", context)]
        fitting = [context[:e] for e in ends if tokens(context[:e], question) <= most]
        whole = context if tokens(context, question) <= most else None
        assert found[ident] == (whole if whole is not None else (fitting or [""])[-1])


def test_replies_are_capped(spark):
    def model():
        return lambda prompts, most: [f" {p} may have {most} tokens of two " for p in prompts]

    rows = spark.createDataFrame([("a",), (None,), ("long reply " * 5,)], "prompt string")
    answer = G.generate(F.col("prompt"), model, most_tokens=9, counter=two_characters)
    found = [r.answer for r in rows.select(answer.alias("answer")).collect()]
    assert found[1] is None and found[0] == "a may have 9 tokens" and found[2] == "long reply long"
