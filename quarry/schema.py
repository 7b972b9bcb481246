"""Declared schemas and defaults."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

ITEM_FIELDS = ("url", "issue", "solution", "product", "category", "depth",
               "sku", "title", "description", "pdf_url")

ITEM = StructType([
    StructField("url", StringType()),
    StructField("issue", StringType()),
    StructField("solution", StringType()),
    StructField("product", StringType()),
    StructField("category", StringType()),
    StructField("depth", IntegerType()),
    StructField("sku", StringType()),
    StructField("title", StringType()),
    StructField("description", StringType()),
    StructField("pdf_url", StringType()),
])

PDF_RECORD = StructType([
    StructField("id", LongType(), False),
    StructField("url", StringType(), False),
    StructField("product", StringType(), False),
    StructField("category", StringType()),
    StructField("issue", StringType()),
    StructField("solution", StringType()),
    StructField("depth", IntegerType()),
    StructField("created_at", TimestampType()),
])

KB_RECORD = StructType([
    StructField("id", LongType()),
    StructField("brand", StringType()),
    StructField("issue", StringType()),
    StructField("solution", StringType()),
    StructField("product", StringType()),
    StructField("category", StringType()),
    StructField("url", StringType()),
])

METADATA = StructType([
    StructField(n, StringType())
    for n in ("brand", "issue", "solution", "product", "category", "url", "db_id")
])

VECTOR = StructType([
    StructField("id", StringType(), False),
    StructField("embedding", ArrayType(FloatType())),
    StructField("metadata", METADATA),
])

PAGE = StructType([
    StructField("page_id", LongType()),
    StructField("url", StringType()),
    StructField("html", StringType()),
    StructField("status", IntegerType()),
    StructField("depth", IntegerType()),
])

# Neutral defaults for the fixed item projection; every loader takes
# its own mapping, these are only the fallback.
ITEM_DEFAULTS = {
    "url": "",
    "product": "unknown product",
    "category": "document",
    "issue": "unknown",
    "solution": "",
    "depth": 0,
}

EMBEDDING_DIM = 64
NO_MATCH = "No match"
