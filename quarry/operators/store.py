"""Table sinks: create, insert-if-absent, ids, narrow append, vector upsert.

Plain Parquet has no transactions, so idempotence comes from the data:
stable keys, an anti join against what is stored, and whole new
versions for upserts (written first, then made current by a small
pointer file).  Re-running a load, or Spark retrying a task, leaves the
stored row counts unchanged.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .dedupe import dedupe_first

CURRENT_POINTER = "_CURRENT"


# --- B4: create if absent ------------------------------------------------

def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Create an empty Parquet table with ``schema`` unless one exists;
    return the table."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


# --- B5/E1: insert if absent ----------------------------------------------

def insert_if_absent(existing: DataFrame, new: DataFrame, key: str, order: str,
                     digest: bool = False) -> DataFrame:
    """Rows of ``new`` to insert: first per key (input order), minus keys
    already stored (the stored row wins).  Null keys never insert."""
    firsts = dedupe_first(new, key, order, digest=digest, keep_null_keys=False)
    # Stored keys de-duplicated first (a partial aggregate), so a key that
    # repeats in the table cannot pile up on one task of the anti join.
    stored = existing.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    return firsts.join(stored, firsts[key] == stored["__key"], "left_anti")


def insert_report(new: DataFrame, inserted: DataFrame) -> DataFrame:
    """``inserted`` and ``skipped`` counted separately."""
    n_new = new.count()
    n_ins = inserted.count()
    spark = new.sparkSession
    return spark.createDataFrame([(n_ins, n_new - n_ins)], "inserted long, skipped long")


# --- B6/G3: dense ids in input order -------------------------------------

def assign_ids(df: DataFrame, order: str, start: int = 1, id_col: str = "id",
               partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` following ``order`` (unique).

    Range-partition and sort by ``order``, write once to the shared
    checkpoint folder (so the partition layout is fixed), count rows per partition (one tiny row each), turn
    the counts into offsets, and add each row's index inside its
    partition.  No single-task global window.
    """
    spark = df.sparkSession
    from ..session import materialize
    # Range count: the session's shuffle-partition setting (the knob sized
    # for the data), unless given.
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        df.repartitionByRange(n, F.col(order))
        .sortWithinPartitions(order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__local", F.monotonically_increasing_id()
                    - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    )
    laid = materialize(laid, "ids")
    counts = laid.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    return (
        laid.join(F.broadcast(offsets), "__pid")
        .withColumn(id_col, (F.lit(start) + F.col("__off") + F.col("__local")).cast("long"))
        .drop("__pid", "__local", "__off")
    )


def next_id(existing: DataFrame, id_col: str = "id") -> int:
    """First free id after the stored ones (SERIAL)."""
    m = existing.agg(F.max(id_col)).first()[0]
    return int(m or 0) + 1


def batch_ids(df: DataFrame, id_col: str = "id", size: int = 100, start: int = 1,
              out: str = "batch_id") -> DataFrame:
    """Fixed-size delivery batches over dense ids."""
    return df.withColumn(out, F.floor((F.col(id_col) - F.lit(start)) / F.lit(size)).cast("long"))


# --- B7: narrow append -----------------------------------------------------

def append_narrow(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that carry only some of the table's columns."""
    return table.unionByName(rows, allowMissingColumns=True).select(*table.columns)


# --- B8: vector upsert ------------------------------------------------------

def upsert(existing: DataFrame, new: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Same key replaces, new key inserts.  Within ``new`` the last row
    per key (``order``) wins."""
    if order:
        # keys and ordinals alone are aggregated; the rows follow by a semi-join
        newest = new.groupBy(key).agg(F.max(order).alias(order))
        last = new.join(newest, [key, order], "left_semi").dropDuplicates([key])
    else:
        last = new.dropDuplicates([key])
    kept = existing.join(last.select(key), key, "left_anti")
    return kept.unionByName(last.select(*existing.columns))


# --- versions ---------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new version under ``root`` and make it current.
    Readers never see a half-written version."""
    spark = df.sparkSession
    version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{version}"
    df.write.mode("errorifexists").parquet(path)
    fs, p = _fs(spark, f"{root.rstrip('/')}/{CURRENT_POINTER}")
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/.{CURRENT_POINTER}.{version}")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode()))
    out.close()
    # one atomic step: a reader sees the old pointer or the new one
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(tmp), fs.makeQualified(p), options)
    return path


def read_current(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame | None:
    fs, p = _fs(spark, f"{root.rstrip('/')}/{CURRENT_POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    data = bytearray()
    b = stream.read()
    while b != -1:
        data.append(b)
        b = stream.read()
    stream.close()
    version = data.decode().strip()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{version}")


# --- B1/B2/B3: file sinks ---------------------------------------------------

def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, UTF-8 unescaped (the scalable feed format)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_routed(df: DataFrame, path: str, route_col: str = "route", mode: str = "overwrite") -> None:
    """Kept and discarded items side by side: ``path/route=kept``,
    ``path/route=discarded`` (one write, partitioned by the route)."""
    df.write.mode(mode).partitionBy(route_col).option("ignoreNullFields", "false").json(path)


def export_json_array(df: DataFrame, path: str, one_file: bool = True) -> None:
    """One JSON array file, or with ``one_file`` False an array file of each
    partition's rows.  One file is one task's work, which reads all rows,
    though they stream through it one Arrow batch at a time: choose array
    files, or ``write_jsonl``, for feeds that grow."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

    def run(batches):
        import pandas as pd

        lead = "["
        for pdf in batches:
            out = "    " + pdf["value"]
            out.iloc[1:] = "," + out.iloc[1:]
            if len(out):
                out.iloc[0] = (lead if lead == "," else "[\n") + out.iloc[0]
                lead = ","
            yield pd.DataFrame({"value": out})
        yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})

    (lines.coalesce(1) if one_file else lines).mapInPandas(run, "value string").write.mode("overwrite").text(path)


# --- B9: batched delivery to an external sink --------------------------------

DELIVERY = "batch long, first_id string, n long, ok boolean, error string"


def deliver(df: DataFrame, send, id_col: str = "id", batch_col: str = "batch_id") -> DataFrame:
    """Hand rows to ``send(list_of_dicts)`` batch by batch, as numbered by
    ``batch_col`` (``batch_ids``: fixed sizes), inside the tasks.  A failing
    batch is reported and skipped, the others go through.  Returns one
    report row per batch; nothing is collected to the driver.  ``send``
    must be idempotent per id (upsert) because Spark may retry a task."""
    import pandas as pd

    def run(key, pdf):
        recs = pdf.drop(columns=[batch_col]).to_dict("records")
        try:
            send(recs)
            ok, err = True, None
        except Exception as e:  # noqa: BLE001 - reported, not raised
            ok, err = False, f"{type(e).__name__}: {e}"[:500]
        return pd.DataFrame({"batch": [key[0]], "first_id": [str(recs[0].get(id_col))], "n": [len(recs)],
                             "ok": [ok], "error": [err]})

    return df.groupBy(batch_col).applyInPandas(run, DELIVERY)


# --- E3: pairing two inputs by ordinal ----------------------------------------

def zip_by_ordinal(left: DataFrame, right: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Pair rows of two inputs by their carried ordinal (an equi join, not
    a positional zip); unmatched rows keep nulls on the other side."""
    return left.join(right, ordinal, "full_outer")
