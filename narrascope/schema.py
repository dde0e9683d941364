"""Column names, schemas and fixed label tables shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCT = "Product"
NARRATIVE = "Consumer complaint narrative"
COMPLAINT_ID = "Complaint ID"
CATEGORY = "product_category"
CLEANED = "cleaned_narrative"
WORDS = "narrative_word_count"
CORRUPT = "_corrupt_record"

# --- Fixed values -----------------------------------------------------------

COMPLAINT_COLUMNS = [
    "Date received",
    "Product",
    "Sub-product",
    "Issue",
    "Sub-issue",
    "Consumer complaint narrative",
    "Company",
    "State",
    "Complaint ID",
]

CATEGORY_OF_PRODUCT = {
    "Credit card": "Credit Card",
    "Credit card or prepaid card": "Credit Card",
    "Payday loan, title loan, or personal loan": "Personal Loan",
    "Payday loan, title loan, personal loan, or advance loan": "Personal Loan",
    "Consumer Loan": "Personal Loan",
    "Checking or savings account": "Savings Account",
    "Money transfer, virtual currency, or money service": "Money Transfer",
    "Money transfers": "Money Transfer",
}

CATEGORIES = ["Credit Card", "Personal Loan", "Savings Account", "Money Transfer"]

CHUNK_METADATA = {
    "complaint_id": "Complaint ID",
    "product_category": "product_category",
    "product": "Product",
    "issue": "Issue",
    "sub_issue": "Sub-issue",
    "company": "Company",
    "state": "State",
    "date_received": "Date received",
}

SAMPLE_SIZE = 12_000
SAMPLE_SEED = 42
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
CHUNK_SEPARATORS = ["\n\n", "\n", ". ", " ", ""]
EMBEDDING_DIM = 384
EMBED_BATCH = 512
TOP_K = 5
PROMPT_TOKENS = 1024
REPLY_TOKENS = 192
NO_CATEGORY_FILTER = "All products"

# --- Schemas ----------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COMPLAINT_COLUMNS])

CLEANED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [T.StructField(CATEGORY, T.StringType()), T.StructField(CLEANED, T.StringType())]
)

CHUNK_SCHEMA = T.StructType(
    [T.StructField("chunk_id", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CHUNK_METADATA]
    + [
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("total_chunks", T.IntegerType()),
    ]
)

STORE_SCHEMA = T.StructType(
    CHUNK_SCHEMA.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
)

QUESTION_SCHEMA = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField(CATEGORY, T.StringType()),
    ]
)
