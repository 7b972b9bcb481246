"""Embedding providers and vector validation.

The default provider is offline and reproducible: tokens are runs of
letters/digits of the lower-cased text, each token falls in bucket
``md5(token)[:8] mod dim``, the bucket counts are L2-normalised.  Token
splitting runs in the JVM; hashing (once per distinct token), the bin
count and the normalisation run on Arrow batches in Python.  A remote provider plugs in via
``embed_with`` (one client per partition, batched by Arrow).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..schema import EMBEDDING_DIM

TOKEN_RE = r"[\p{L}\p{N}]+"


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_RE), 0)


def token_buckets(text, dim: int = EMBEDDING_DIM) -> Column:
    """array<long>: the hash bucket of every token, in order."""
    return F.transform(
        tokens(text),
        lambda tok: F.pmod(F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("long"), F.lit(dim)),
    )


#: Rows whose tokens are counted together.
ROWS = 1024


def hashed_counts(tokens: pa.Array, dim: int) -> pa.Array:
    """The normalised bucket counts of each row of an Arrow array of token
    lists; tokens stay in Arrow, their distinct ones alone are hashed."""
    out = []
    for at in range(0, len(tokens), ROWS):
        part = tokens.slice(at, ROWS)
        words = part.flatten().dictionary_encode()
        buckets = np.array([int(hashlib.md5(t.encode("utf-8")).hexdigest()[:8], 16) % dim for t in words.dictionary.to_pylist()], dtype=np.int64)
        row = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
        v = np.bincount(row * dim + buckets[words.indices.to_numpy(zero_copy_only=False)], minlength=len(part) * dim).astype(np.float64).reshape(len(part), dim)
        n = np.sqrt((v * v).sum(axis=1, keepdims=True))
        v = np.divide(v, n, out=v, where=n > 0)
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * dim)
        out.append(pa.ListArray.from_arrays(offsets, pa.array(v.ravel()), mask=part.is_null()))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.float64()))


def _hashed_udf(dim: int):
    @arrow_udf(ArrayType(DoubleType()))
    def hashed(tokens: pa.Array) -> pa.Array:
        return hashed_counts(tokens, dim)
    return hashed


def hashed_embedding(text, dim: int = EMBEDDING_DIM) -> Column:
    """L2-normalised hashed bag-of-words vector (array<double>, length
    ``dim``; all zeros for text without tokens; null for null text).
    Tokenisation is native; the bucket of a token is
    ``int(md5(token)[:8], 16) mod dim``, computed once per distinct token
    of some rows of an Arrow batch."""
    return _hashed_udf(dim)(tokens(text))


def embed_hashed(df: DataFrame, text_col: str, dim: int = EMBEDDING_DIM,
                 out: str = "embedding") -> DataFrame:
    return df.withColumn(out, hashed_embedding(text_col, dim))


def embedding_long(df: DataFrame, keys, vec_col: str = "embedding", digits: int = 6) -> DataFrame:
    """Sparse long form ``(*keys, bucket, weight)`` of non-zero weights."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    # posexplode_outer: no inferred size() filter, which would make Spark
    # evaluate the embedding UDF a second time.
    return (
        df.select(*keys, F.posexplode_outer(vec_col).alias("bucket", "weight"))
        .where(F.col("weight") != 0)
        .select(*keys, F.col("bucket").cast("long").alias("bucket"),
                F.round("weight", digits).alias("weight"))
    )


def embed_with(df: DataFrame, text_col: str, provider: Callable[[list[str]], list],
               dim: int, out: str = "embedding", max_chars: int | None = 8192) -> DataFrame:
    """Embed through a user provider: ``provider(texts) -> vectors`` is
    called once per Arrow batch inside each task.  A failed batch or a
    wrong-length vector yields null (counted by ``validate_dimension``)."""
    cols = df.columns
    # A new schema (StructType.add would change the DataFrame's own one).
    schema = StructType(list(df.schema.fields) + [StructField(out, ArrayType(DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str)
            if max_chars:
                texts = texts.str.slice(0, max_chars)
            try:
                vecs = provider(texts.tolist())
            except Exception:  # provider outage: rows get null vectors
                vecs = [None] * len(pdf)
            pdf = pdf[cols].copy()
            pdf[out] = [list(map(float, v)) if v is not None and len(v) == dim else None for v in vecs]
            yield pdf

    return df.mapInPandas(run, schema)


def validate_dimension(df: DataFrame, vec_col: str = "embedding", dim: int = EMBEDDING_DIM) -> DataFrame:
    """Adds ``vector_status``: 'ok', 'missing' (null) or 'wrong_dim'."""
    v = F.col(vec_col)
    return df.withColumn(
        "vector_status",
        F.when(v.isNull(), F.lit("missing"))
        .when(F.size(v) != dim, F.lit("wrong_dim"))
        .otherwise(F.lit("ok")),
    )
