"""Keep-first de-duplication and request fingerprints.

``dedupe_first`` works in two steps: the least ordinal of each key, a
partial aggregate over keys and ordinals alone, then a semi-join of the
rows on (key, ordinal).  No row is carried through the aggregation, a key
that holds a third of all rows leaves each map task as one small row, and
the join is hash-partitioned by pairs that are unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dedupe_first(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                 digest: bool = False, keep_null_keys: bool = True) -> DataFrame:
    """Keep, per key, the row with the smallest ``order`` (input order).

    ``digest=True`` compares the SHA-256 of the key text, which keeps long
    keys (whole documents) out of the shuffle.  Rows whose key is null are
    never merged: they group by their own ordinal (and pass through, or are
    dropped with ``keep_null_keys=False``).  ``order`` is unique per row.
    """
    keys, order = _keys(keys), _keys(order)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    if not keep_null_keys:
        df = df.where(~null_key)
    names = [f"__k{i}" for i in range(len(keys))]
    own = F.when(null_key, F.struct(*[F.col(o) for o in order]))
    parts = [F.sha2(F.col(k).cast("string"), 256) if digest else F.col(k) for k in keys]
    tagged = df.select("*", *[p.alias(n) for p, n in zip(parts, names, strict=True)], own.alias("__nk"))
    least = F.min(F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order]))
    firsts = tagged.select(*names, "__nk", *order).groupBy(*names, "__nk").agg(least.alias("__o"))
    firsts = firsts.select(*[F.col(n).alias(f"{n}f") for n in names],
                           *[(F.col("__o") if len(order) == 1 else F.col(f"__o.{o}")).alias(f"__o{i}") for i, o in enumerate(order)])
    # an ordinal is unique, so a null key needs no null group of its own here
    on = [F.col(n).eqNullSafe(F.col(f"{n}f")) for n in names] + [F.col(o).eqNullSafe(F.col(f"__o{i}")) for i, o in enumerate(order)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return tagged.join(firsts, cond, "left_semi").select(*df.columns)


def flag_first(df: DataFrame, keys: str | Sequence[str], order: str,
               digest: bool = False, flag: str = "is_first") -> DataFrame:
    """Adds a boolean ``flag``: the row is the first of its key.

    The first ordinal per key is a partial aggregate (one row per key per
    task); it is joined back on *key and ordinal*, so the join is
    hash-partitioned by a unique pair and a hot key is spread over all
    tasks instead of landing on one."""
    keys = _keys(keys)
    if digest:
        kcols = [F.sha2(F.col(k).cast("string"), 256).alias(f"__k{i}") for i, k in enumerate(keys)]
        df2 = df.select("*", *kcols)
        knames = [f"__k{i}" for i in range(len(keys))]
    else:
        df2, knames = df, keys
    firsts = df2.groupBy(*knames).agg(F.min(order).alias("__order"))
    firsts = firsts.select(*[F.col(k).alias(f"__f{i}") for i, k in enumerate(knames)], "__order", F.lit(True).alias("__first"))
    cond = F.col(order) == F.col("__order")
    for i, k in enumerate(knames):  # a null key has a first row too
        cond = cond & F.col(k).eqNullSafe(F.col(f"__f{i}"))
    return (
        df2.join(firsts, cond, "left")
        .withColumn(flag, F.coalesce(F.col("__first"), F.lit(False)))
        .select(*df.columns, flag)
    )


def with_fingerprint(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``canonical_url`` and its SHA-1 ``fingerprint``."""
    return (
        df.withColumn("canonical_url", U.canonical_url(F.col(url_col)))
        .withColumn("fingerprint", U.fingerprint(F.col("canonical_url")))
    )


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.sha2(F.col(key).cast("string"), 256)).alias("n_distinct"),
    )
