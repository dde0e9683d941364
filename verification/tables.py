"""Complaints and questions derived from the given tables, for the registered queries.

Every row of ``documents``, ``conversations`` and ``orders`` becomes one complaint with
its whole text. Documents and turns carry narratives, some behind boilerplate openers and
redactions; orders are the complaints without a usable narrative, which outnumber the
others as in a real export. The SQL is run by Spark and by the checking engine alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from narrascope.functions.bounds import spread

DOCUMENT_COMPLAINTS = """
SELECT CAST(DATE '2024-01-01' + CAST(n_chars % 365 AS INT) AS STRING) AS `Date received`,
       CASE source
            WHEN 'src0' THEN 'Credit card'
            WHEN 'src1' THEN 'Credit card or prepaid card'
            WHEN 'src2' THEN 'Payday loan, title loan, or personal loan'
            WHEN 'src3' THEN 'Payday loan, title loan, personal loan, or advance loan'
            WHEN 'src4' THEN 'Consumer Loan'
            WHEN 'src5' THEN 'Checking or savings account'
            WHEN 'src6' THEN 'Money transfer, virtual currency, or money service'
            WHEN 'src7' THEN 'Money transfers'
            WHEN 'src16' THEN 'Mortgage'
            WHEN 'src17' THEN 'Debt collection'
            WHEN 'src18' THEN 'credit card'
            WHEN 'src19' THEN NULL
            ELSE 'Credit card' END AS `Product`,
       lang AS `Sub-product`,
       concat('Problem with ', source) AS `Issue`,
       CAST(NULL AS STRING) AS `Sub-issue`,
       CASE lang
            WHEN 'en' THEN concat('I am writing to file a complaint about XXXX ', text)
            WHEN 'de' THEN concat('To whom it may concern: Exxon ', text)
            WHEN 'es' THEN concat('This is a complaint  regarding XX/XX/2020 ', text)
            ELSE text END AS `Consumer complaint narrative`,
       concat('Company | ', source) AS `Company`,
       upper(lang) AS `State`,
       concat('D', CAST(doc_id AS STRING)) AS `Complaint ID`
FROM documents
"""

TURN_COMPLAINTS = """
SELECT '2024-06-30' AS `Date received`,
       CASE role WHEN 'user' THEN 'Money transfers'
                 WHEN 'assistant' THEN 'Checking or savings account'
                 ELSE 'Mortgage' END AS `Product`,
       role AS `Sub-product`,
       'Conversation' AS `Issue`,
       '' AS `Sub-issue`,
       text AS `Consumer complaint narrative`,
       CAST(NULL AS STRING) AS `Company`,
       CAST(NULL AS STRING) AS `State`,
       concat('C', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS `Complaint ID`
FROM conversations
"""

ORDER_COMPLAINTS = """
SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS `Date received`,
       CASE o_orderpriority
            WHEN '1-URGENT' THEN 'Credit reporting or other personal consumer reports'
            WHEN '2-HIGH' THEN 'Credit card'
            WHEN '3-MEDIUM' THEN 'Consumer Loan'
            WHEN '4-NOT SPECIFIED' THEN 'Debt collection'
            ELSE NULL END AS `Product`,
       CAST(NULL AS STRING) AS `Sub-product`,
       o_orderpriority AS `Issue`,
       CAST(NULL AS STRING) AS `Sub-issue`,
       CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '  \t\n ' ELSE 'XXXX' END
            AS `Consumer complaint narrative`,
       'Orders' AS `Company`,
       CAST(NULL AS STRING) AS `State`,
       concat('O', CAST(o_orderkey AS STRING)) AS `Complaint ID`
FROM orders
"""


# Turns as questions: system turns are blank, and some ask within a category, one of which
# holds no complaint at all.
TURN_QUESTIONS = """
SELECT conv_id * 1000 + turn AS question_id,
       CASE role WHEN 'system' THEN ' \t\n ' ELSE concat(' ', text, ' ') END AS question,
       CASE WHEN role = 'user' THEN 'All products'
            WHEN turn = 1 THEN 'Credit Card'
            WHEN turn = 2 THEN 'Savings Account'
            WHEN turn = 3 THEN 'Mortgage'
            WHEN turn = 4 THEN ''
            ELSE NULL END AS product_category
FROM conversations
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out to all cores where they come as one row group."""
    return spread(table(spark, sf_dir, "documents"))


def derive(df: DataFrame, sql: str, name: str) -> DataFrame:
    """Run one of the derivations above over a batch or streaming frame."""
    return df.sparkSession.sql(sql.replace(f"FROM {name}", "FROM {rows}"), rows=df)


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        derive(texts(spark, sf_dir), DOCUMENT_COMPLAINTS, "documents"),
        derive(table(spark, sf_dir, "conversations"), TURN_COMPLAINTS, "conversations"),
        derive(table(spark, sf_dir, "orders"), ORDER_COMPLAINTS, "orders"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "conversations"), TURN_QUESTIONS, "conversations")
