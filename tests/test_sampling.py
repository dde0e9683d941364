import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from narrascope.operators.sampling import sample_balance, sample_quotas, stratified_sample
from narrascope.schema import CATEGORY, COMPLAINT_ID


def frame(spark, **sizes):
    rows = [(g.replace("_", " "), f"{g}{i}") for g, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, f"{CATEGORY} string, `{COMPLAINT_ID}` string")


def counts(df):
    return Counter(r[CATEGORY] for r in df.collect())


def test_proportions_and_size(spark):
    df = frame(spark, Credit_Card=800, Savings_Account=150, Personal_Loan=50)
    assert counts(stratified_sample(df, 200, 0)) == {
        "Credit Card": 160, "Savings Account": 30, "Personal Loan": 10,
    }


def test_all_rows_when_n_exceeds_them(spark):
    df = frame(spark, a=10, b=5, c=5)
    assert stratified_sample(df, 10_000).count() == 20
    assert stratified_sample(df, 20).count() == 20


@pytest.mark.parametrize("digits", [1, 4])
def test_same_rows_for_any_partitioning(spark, digits):
    df = frame(spark, Credit_Card=800, Savings_Account=150, Personal_Loan=50)
    ids = [
        sorted(r[COMPLAINT_ID] for r in stratified_sample(d, 100, 7, slice_digits=k).collect())
        for d, k in ((df, 4), (df.repartition(7), digits), (df.orderBy(F.rand(3)), digits))
    ]
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == 100
    other = stratified_sample(df, 100, 8).collect()
    assert sorted(r[COMPLAINT_ID] for r in other) != ids[0]


def test_published_quotas(spark):
    sizes = {"Credit Card": 189333, "Savings Account": 140317, "Money Transfer": 98684, "Personal Loan": 35595}
    df = spark.createDataFrame(list(sizes.items()), f"{CATEGORY} string, n int").select(
        CATEGORY, F.explode(F.sequence(F.lit(1), "n"))
    )
    found = {r[CATEGORY]: r.quota for r in sample_quotas(df, 12_000).collect()}
    assert found == {
        "Credit Card": 4897, "Savings Account": 3629, "Money Transfer": 2553, "Personal Loan": 921,
    }


def test_ties_go_to_the_first_name(spark):
    found = {r[CATEGORY]: r.quota for r in sample_quotas(frame(spark, a=5, b=5, c=5), 4).collect()}
    assert found == {"a": 2, "b": 1, "c": 1}


def test_null_stratum_is_kept(spark):
    df = frame(spark, a=6).unionByName(
        frame(spark, x=4).withColumn(CATEGORY, F.lit(None).cast("string"))
    )
    assert counts(stratified_sample(df, 5)) == {"a": 3, None: 2}


def test_copies_and_repeated_ids_do_not_change_the_size(spark):
    copies = spark.range(700).select(
        F.lit("a").alias(CATEGORY), F.lit("same").alias(COMPLAINT_ID), F.lit(0).alias("n")
    )
    others = spark.range(300).select(
        F.lit("a").alias(CATEGORY), F.lit("other").alias(COMPLAINT_ID), F.col("id").cast("int").alias("n")
    )
    df = copies.unionByName(others)
    for n, limit in itertools.product((1, 250, 699, 701, 999), (1_000_000, 5)):
        rows = stratified_sample(df, n, rank_limit=limit).collect()
        assert len(rows) == n
        distinct = [r.n for r in rows if r[COMPLAINT_ID] == "other"]
        assert len(set(distinct)) == len(distinct)


def test_a_stratum_without_ids_is_sliced_by_whole_rows(spark):
    df = spark.range(400).select(
        F.lit("a").alias(CATEGORY), F.lit(None).cast("string").alias(COMPLAINT_ID), F.col("id").alias("n")
    )
    found = [
        sorted(r.n for r in stratified_sample(df.repartition(parts), 150, rank_limit=limit, slice_digits=d).collect())
        for parts, limit, d in ((1, 1_000_000, 4), (5, 10, 4), (3, 10, 1))
    ]
    assert found[0] == found[1] == found[2] and len(set(found[0])) == 150


def test_draw_order_on_request(spark):
    df = frame(spark, a=50, b=50)
    rows = [r[COMPLAINT_ID] for r in stratified_sample(df, 40, shuffle=True).collect()]
    assert rows == [r[COMPLAINT_ID] for r in stratified_sample(df.repartition(3), 40, shuffle=True).collect()]
    assert rows != sorted(rows)


def test_balance(spark):
    df = frame(spark, a=60, b=40)
    found = {(r.stage, r[CATEGORY]): r.share for r in sample_balance(df, stratified_sample(df, 10)).collect()}
    assert found == {("before", "a"): 0.6, ("before", "b"): 0.4, ("after", "a"): 0.6, ("after", "b"): 0.4}
