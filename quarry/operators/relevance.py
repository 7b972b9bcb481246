"""Relevance classification of items.

The reference asks a remote chat model "relevant? yes/no" per item.
Here three providers share one contract (the whole text, or its first
``max_chars`` characters where a remote provider has such a limit; verdict
normalised by ``lower(trim(v)) = 'yes'``):

* ``topic_rule`` - native regex over a topic list (default);
* ``train_model`` / ``apply_model`` - MLlib tokenizer → hashing TF →
  logistic regression, trained on labelled rows;
* ``with_provider`` - any user function over Arrow batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The topics named in the reference's two relevance
# prompts, in the order given there.
TOPICS = (
    "home automation", "equipment racks", "switches", "receivers", "matrix amps",
    "audio", "video", "routers", "tvs", "cameras",
    "lighting", "automation", "switches", "integration",
)


def _text(text_col: str, max_chars: int | None) -> Column:
    return F.col(text_col) if max_chars is None else T.truncate(F.col(text_col), max_chars)


def topic_pattern(topics: Sequence[str] = TOPICS) -> str:
    """Whole-word (letter/digit boundaries) alternation of the topics;
    readable by Java and RE2 alike."""
    alts = "|".join(dict.fromkeys(t.lower() for t in topics))
    return r"(^|[^\p{L}\p{N}])(" + alts + r")([^\p{L}\p{N}]|$)"


def normalise_verdict(v) -> Column:
    """True only for a verdict that is 'yes' after lower + strip."""
    c = F.col(v) if isinstance(v, str) else v
    return F.coalesce(F.lower(T.ustrip(c)) == F.lit("yes"), F.lit(False))


def topic_rule(df: DataFrame, text_col: str, topics: Sequence[str] = TOPICS,
               max_chars: int | None = None) -> DataFrame:
    """Adds ``verdict`` ('yes'/'no') and ``relevant`` (bool)."""
    hit = F.lower(_text(text_col, max_chars)).rlike(topic_pattern(topics))
    return (
        df.withColumn("verdict", F.when(F.coalesce(hit, F.lit(False)), F.lit("yes")).otherwise(F.lit("no")))
        .withColumn("relevant", normalise_verdict("verdict"))
    )


def train_model(labelled: DataFrame, text_col: str = "text", label_col: str = "label",
                num_features: int = 1 << 16, max_chars: int | None = None):
    """Fit a distributed MLlib pipeline on labelled rows."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    from ..session import checkpoint_dir

    data = labelled.select(_text(text_col, max_chars).alias("__text"),
                           F.col(label_col).cast("double").alias("__label"))
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="__text", outputCol="__tok", pattern=r"[\p{L}\p{N}]+", gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        LogisticRegression(featuresCol="__tf", labelCol="__label", maxIter=20, regParam=0.01),
    ])
    model = pipe.fit(data)
    # Keep the fitted model on shared storage and score with the stored
    # copy: it is reusable by other jobs and carries no training summary
    # (which holds the session and cannot be shipped to executors).
    path = f"{checkpoint_dir(labelled.sparkSession).rstrip('/')}/quarry-model-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)


def apply_model(model, df: DataFrame, text_col: str = "text",
                max_chars: int | None = None) -> DataFrame:
    scored = model.transform(df.withColumn("__text", _text(text_col, max_chars)))
    return (
        scored.withColumn("verdict", F.when(F.col("prediction") == 1.0, F.lit("yes")).otherwise(F.lit("no")))
        .withColumn("relevant", normalise_verdict("verdict"))
        .drop("__text", "__tok", "__tf", "rawPrediction", "probability", "prediction")
    )


def with_provider(df: DataFrame, text_col: str, provider: Callable[[list[str]], list[str]],
                  max_chars: int | None = None) -> DataFrame:
    """User classifier called once per Arrow batch; a failed batch gives
    null verdicts (not relevant)."""
    from pyspark.sql.types import StringType, StructField, StructType

    cols = df.columns
    schema = StructType(list(df.schema.fields) + [StructField("verdict", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).str.slice(0, max_chars).tolist()  # None: whole
            try:
                verdicts = provider(texts)
            except Exception:  # provider outage
                verdicts = [None] * len(texts)
            out = pdf[cols].copy()
            out["verdict"] = verdicts
            yield out

    return df.mapInPandas(run, schema).withColumn("relevant", normalise_verdict("verdict"))
