from narrascope.operators import cleaning, profile
from narrascope.schema import CATEGORY, CLEANED, COMPLAINT_COLUMNS, NARRATIVE, PRODUCT, WORDS


def test_filter_keeps_target_products_with_narratives(raw):
    rows = cleaning.filter_complaints(raw).collect()
    assert {r[CATEGORY] for r in rows} == {"Credit Card", "Money Transfer"}
    assert len(rows) == 2


def test_label_filter_reaches_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    kept = cleaning.filter_complaints(spark.read.parquet(str(tmp_path / "raw")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "In(Product" in plan and "IsNotNull(`Consumer complaint narrative`)" in plan


def test_presence(raw):
    assert profile.narrative_presence(raw).first().asDict() == {
        "with_narrative": 3,
        "without_narrative": 1,
    }
    assert tuple(profile.narrative_presence(raw.limit(0)).first()) == (0, 0)


def test_word_counts(raw):
    assert [r[WORDS] for r in profile.add_narrative_length(raw).collect()] == [2, 0, 1, 2]


def test_distribution_counts_the_null_label(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",), ("b",)], f"`{PRODUCT}` string")
    assert [tuple(r) for r in profile.product_distribution(df).collect()] == [
        ("b", 2), ("a", 1), (None, 1),
    ]
    assert [r[0] for r in profile.top_products(df, 1).collect()] == ["b"]
    assert profile.label_cardinality(df).first()[0] == 2
    shares = {r[PRODUCT]: r.share for r in profile.label_shares(df, PRODUCT).collect()}
    assert shares == {"b": 0.5, "a": 0.25, None: 0.25}


def test_length_statistics_on_no_rows_and_equal_lengths(spark, raw):
    empty = profile.length_summary(raw.limit(0)).first()
    assert empty["count"] == 0 and empty["mean"] is None
    same = spark.createDataFrame([("a b",), ("c d",)], f"`{NARRATIVE}` string")
    assert [tuple(r) for r in profile.length_histogram(same).collect()] == [(0, 2.0, 2)]
    row = profile.length_summary(same).first()
    assert (row["mean"], row["std"], row["median"]) == (2.0, 0.0, 2.0)


def test_describe_takes_the_nearest_observed_value(raw):
    row = profile.length_describe(raw).first()
    # Word counts 0, 1, 2, 2: places 0.75, 1.5 and 2.25 of the last place 3.
    assert (row["count"], row["min"], row.p25, row.p50, row.p75, row["max"]) == (4, 0, 1, 2, 2, 2)
    assert profile.length_describe(raw.limit(0)).first()["count"] == 0


def test_cleaning_drops_what_becomes_empty_and_cleans_once(spark):
    df = spark.createDataFrame(
        [("Credit card", "XXXX"), ("Credit card", "Fee!"), ("Money transfers", None)],
        f"`{PRODUCT}` string, `{NARRATIVE}` string",
    )
    cleaned = cleaning.clean_narratives(cleaning.filter_complaints(df))
    assert [r[CLEANED] for r in cleaned.collect()] == ["fee!"]
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("x{2,}") == 1


def test_stage_counts(spark):
    df = spark.createDataFrame(
        [("Credit card", "XXXX"), ("Credit card", "Fee!"), ("Credit card", " "), ("Mortgage", "x")],
        f"`{PRODUCT}` string, `{NARRATIVE}` string",
    )
    found = {(r[CATEGORY], r.stage): r.complaints for r in cleaning.stage_counts(df).collect()}
    assert found[("Credit Card", "raw")] == 3
    assert found[("Credit Card", "narrative")] == 2
    assert found[("Credit Card", "cleaned")] == 1
    assert found[(None, "raw")] == 1 and found[(None, "mapped")] == 0


def test_keep_columns(spark):
    df = spark.createDataFrame([tuple("abcdefghij")], [*COMPLAINT_COLUMNS, "other"])
    assert cleaning.keep_columns(df).columns == COMPLAINT_COLUMNS
