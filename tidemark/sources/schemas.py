"""Declared schemas. Ingest never infers a type."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of one raw event.
RAW_FIELDS = [
    ("event_id", "string"),
    ("timestamp", "string"),
    ("user_id", "string"),  # text, since some records hold a bad id
    ("event_type", "string"),
    ("device", "string"),
    ("country", "string"),
    ("session_id", "string"),
    ("product_id", "string"),
    ("category", "string"),
    ("price", "double"),
    ("quantity", "int"),
    ("total_amount", "double"),
    ("search_query", "string"),
]
_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}
RAW_EVENT = T.StructType([T.StructField(n, _TYPES[t]) for n, t in RAW_FIELDS])

# The same record with every field as text: a number field that holds a word
# then spoils that field only, not the record.
RAW_EVENT_TEXT = T.StructType([T.StructField(n, T.StringType()) for n, _ in RAW_FIELDS])

# The category dimension.
CATEGORY_SCHEMA = "category string, department string, tax_rate double"
CATEGORY_ROWS = [
    ("Electronics", "Tech", 0.08),
    ("Clothing", "Fashion", 0.05),
    ("Books", "Media", 0.0),
    ("Home", "Lifestyle", 0.06),
    ("Sports", "Active", 0.05),
    ("Beauty", "Personal", 0.07),
]

# Value domains of the clickstream.
DEVICES = ["mobile", "desktop", "tablet"]
COUNTRIES = ["US", "UK", "DE", "FR", "CA", "AU", "JP", "IN"]
CATEGORIES = [row[0] for row in CATEGORY_ROWS]
