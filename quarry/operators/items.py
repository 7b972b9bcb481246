"""Item records: projection, defaults, normalisation, routing, texts.

An item is a loosely structured record (``url, issue, solution,
product, category, depth`` plus producer-specific extras).  All
operators are narrow column expressions; ``DataFrame.transform`` chains
them, and the same functions run unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import ITEM_DEFAULTS

ROUTE_KEPT = "kept"
ROUTE_DISCARDED = "discarded"


def documents_as_items(docs: DataFrame) -> DataFrame:
    """Stand-in item view over a ``documents`` table: the first line is
    the issue, the whole text the solution, ``source`` the product,
    ``lang`` the category and ``doc_id`` the input ordinal."""
    return docs.select(
        F.col("doc_id").alias("ordinal"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/doc/"),
                 F.col("doc_id").cast("string")).alias("url"),
        T.first_line("text").alias("issue"),
        F.col("text").alias("solution"),
        F.col("source").alias("product"),
        F.col("lang").alias("category"),
        F.lit(0).alias("depth"),
    )


def trim_fields(df: DataFrame, columns=None) -> DataFrame:
    """``str.strip()`` on every string column (or the given ones); other
    types pass through untouched."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.select(*[T.ustrip(c).alias(c) if c in names else F.col(c) for c in df.columns])


def project_defaults(df: DataFrame, defaults: Mapping[str, object] = ITEM_DEFAULTS,
                     or_empty: bool = False) -> DataFrame:
    """Fixed projection with per-column defaults.  ``dict.get`` semantics
    (only missing/null defaulted) unless ``or_empty`` (``x or d``)."""
    out = []
    for name, d in defaults.items():
        col = F.col(name) if name in df.columns else F.lit(None)
        if or_empty and isinstance(d, str):
            out.append(T.or_default(col.cast("string"), d).alias(name))
        else:
            out.append(F.coalesce(col, F.lit(d)).alias(name))
    extra = [c for c in df.columns if c not in defaults]
    return df.select(*extra, *out)


def normalise_keys(df: DataFrame) -> DataFrame:
    """``title`` → ``issue`` and ``description`` → ``solution`` with the
    new key winning when it is present and not null."""
    cols = set(df.columns)
    issue = F.col("issue") if "issue" in cols else F.lit(None).cast("string")
    solution = F.col("solution") if "solution" in cols else F.lit(None).cast("string")
    if "title" in cols:
        issue = F.coalesce(F.col("title"), issue)
    if "description" in cols:
        solution = F.coalesce(F.col("description"), solution)
    return df.withColumn("issue", issue).withColumn("solution", solution)


def route(df: DataFrame, fields=("issue", "solution", "product")) -> DataFrame:
    """Adds ``route``: 'kept' if any of ``fields`` is non-blank."""
    any_set = F.lit(False)
    for f in fields:
        c = F.col(f) if f in df.columns else F.lit(None).cast("string")
        any_set = any_set | ~T.is_blank(c)
    return df.withColumn("route", F.when(any_set, F.lit(ROUTE_KEPT)).otherwise(F.lit(ROUTE_DISCARDED)))


def non_blank(df: DataFrame, col: str = "text") -> DataFrame:
    return df.where(~T.is_blank(F.col(col)))


# Embedding input text, four layouts.
EMBED_LAYOUTS = {
    "catalogue": ("product", "category", "issue", "solution"),
    "kb": ("issue", "solution", "product"),
    "branded": ("brand", "issue", "solution", "product"),
}


def embed_text(df: DataFrame, layout: str = "kb", out: str = "embed_text",
               strip: bool = False) -> DataFrame:
    cols = [F.col(c) if c in df.columns else F.lit(None) for c in EMBED_LAYOUTS[layout]]
    txt = T.concat_fields(*cols)
    return df.withColumn(out, T.ustrip(txt) if strip else txt)


def brand_column(source: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Brand from a small source→brand mapping, as a literal map lookup
    (no join, no broadcast; the mapping is a bounded literal)."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return F.coalesce(F.element_at(m, source), F.lit(default))


def brand_by_table(df: DataFrame, brands: DataFrame, source_col: str = "source",
                   default: str = "generic") -> DataFrame:
    """Brand from a mapping table (``source, brand``): an ordinary join; the
    optimizer knows the table's size."""
    return (
        df.join(brands.withColumnRenamed("source", "__src"), F.col(source_col) == F.col("__src"), "left")
        .withColumn("brand", F.coalesce(F.col("brand"), F.lit(default)))
        .drop("__src")
    )


def fallback_text(df: DataFrame, prefer: str = "solution", sep: str = " ") -> DataFrame:
    """``item.get('solution', ' '.join(str(v) for v in item.values()))``."""
    others = [F.col(c).cast("string") for c in df.columns if c != prefer]
    return df.withColumn("fallback_text", F.coalesce(F.col(prefer), F.concat_ws(sep, *others)))


def record_ids(df: DataFrame, text_col: str, ordinal_col: str, prefix: str = "doc_") -> DataFrame:
    """Stable ids: content hash and ``prefix + ordinal``."""
    return df.withColumn("content_id", F.sha2(F.col(text_col), 256)).withColumn(
        "ordinal_id", F.concat(F.lit(prefix), F.col(ordinal_col).cast("string")))


def vector_metadata(brand: Column, issue: Column, solution: Column, product: Column,
                    category: Column, url: Column, db_id: Column, gated: bool = True) -> Column:
    """The metadata record stored with a vector; ``gated`` blanks solutions
    of 100 words or more (``backfill`` recovers them)."""
    return F.struct(
        brand.alias("brand"), issue.alias("issue"),
        (T.word_gate(solution) if gated else solution).alias("solution"),
        product.alias("product"), category.alias("category"), url.alias("url"),
        db_id.cast("string").alias("db_id"),
    )

