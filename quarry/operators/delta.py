"""Bucketed tables whose loads add delta files: a load reads and writes only
the buckets that its keys fall into.

Layout under ``root``::

    data/load=<n>-<uid>/bucket=<b>/part-*.parquet
    manifests/<version>.json

A key's bucket is a hash of the key alone.  The newest manifest lists, for
each bucket, the loads whose files make up its rows: a base and the deltas
since, in order; of rows with one key the latest load's counts.  A manifest
is put in place by an exclusive rename after its data, so readers see a load
whole or not at all, files of a failed load are never listed, and of two
writers at once the later one fails with ``ConcurrentLoad`` and may start
again.  Manifests are metadata: one short entry per bucket and load, cut back
by ``compact``; choose ``buckets`` so that a bucket is some 256 MB.

Loads are safe to repeat: ``insert_new`` finds its keys stored, ``upsert``
writes equal rows again, and a load that names a ``txn`` (a source and a
number that grows, such as a stream's batch) is skipped where it was applied.
Null keys are never stored; reports count them.  Files that no manifest lists
any more stay in place for readers of older versions.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .store import _fs, assign_ids

KEPT_MANIFESTS = 50
BUCKET = "bucket"
ROW, PLACE, PART, MARK = "__row", "__place", "__part", "__mark"
#: Rows of a load that make one file of a bucket.
FILE_ROWS = 20_000


class ConcurrentLoad(RuntimeError):
    """Another load was committed first."""


@dataclass(frozen=True)
class Manifest:
    version: int
    key: str
    buckets: int
    schema: dict
    next_id: int = 1
    loads: dict[str, list[str]] = field(default_factory=dict)  # bucket -> loads, oldest first
    applied: dict[str, int] = field(default_factory=dict)  # source -> its last number

    def files(self, buckets=None) -> list[tuple[int, str]]:
        """(bucket, load) of every stored file, of some buckets or of all."""
        return [(int(b), one) for b, loads in self.loads.items() if buckets is None or int(b) in buckets for one in loads]


@dataclass(frozen=True)
class Report:
    version: int
    rows_in: int
    null_keys: int
    written: int
    buckets_touched: int
    files_read: int
    files_total: int
    skipped: bool = False


def bucket_of(key: Column | str, buckets: int) -> Column:
    """The key's bucket: its MD5's first 32 bits, modulo ``buckets``."""
    col = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(col.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


# --- manifests ----------------------------------------------------------------

def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/manifests/{version:010d}.json"


def manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest, or None where no table is."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(folder):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    if not names:
        return None
    stream = fs.open(_fs(spark, f"{root.rstrip('/')}/manifests/{names[-1]}")[1])
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _commit(spark: SparkSession, root: str, m: Manifest) -> Manifest:
    fs, target = _fs(spark, _manifest_path(root, m.version))
    fs.mkdirs(target.getParent())
    tmp = _fs(spark, f"{root.rstrip('/')}/manifests/.{m.version}.{uuid.uuid4().hex}")[1]
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(asdict(m)).encode()))
    out.close()
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), none)
    except Exception as e:
        fs.delete(tmp, False)
        if fs.exists(target):
            raise ConcurrentLoad(f"version {m.version} of {root} was committed by another load") from e
        raise
    old = _fs(spark, _manifest_path(root, m.version - KEPT_MANIFESTS))[1]
    if fs.exists(old):
        fs.delete(old, False)
    return m


def create(spark: SparkSession, root: str, schema: StructType, key: str, buckets: int) -> Manifest:
    """An empty table unless one is there; returns its newest manifest."""
    found = manifest(spark, root)
    if found is not None:
        return found
    if key not in schema.names or BUCKET in schema.names:
        raise ValueError(f"the schema must have {key!r} and no column {BUCKET!r}")
    try:
        return _commit(spark, root, Manifest(0, key, buckets, json.loads(schema.json())))
    except ConcurrentLoad:
        return manifest(spark, root)


def _table(spark: SparkSession, root: str) -> Manifest:
    m = manifest(spark, root)
    if m is None:
        raise ValueError(f"no table under {root}")
    return m


# --- reading ------------------------------------------------------------------

def _scan(spark: SparkSession, root: str, m: Manifest, files: list[tuple[int, str]]) -> DataFrame:
    """The rows of some files, with their bucket and ``load``."""
    schema = StructType.fromJson(m.schema).add(BUCKET, "integer").add("load", "string")
    if not files:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/data"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/load={load}/{BUCKET}={b}" for b, load in files])


def _current(spark: SparkSession, root: str, m: Manifest, buckets=None, wanted: DataFrame | None = None) -> DataFrame:
    """The table's rows (with ``bucket``), of some buckets or of all; with
    ``wanted`` (distinct keys) the rows of those keys alone.  Keys decide
    which files count whole and which not at all; only the rows of the others
    are joined."""
    names = StructType.fromJson(m.schema).names + [BUCKET]
    chosen = {int(b): loads for b, loads in m.loads.items() if buckets is None or int(b) in buckets}
    open_ = {b: loads for b, loads in chosen.items() if len(loads) > 1 or wanted is not None}
    whole = [(b, loads[0]) for b, loads in chosen.items() if b not in open_]
    if not open_:
        return _scan(spark, root, m, whole).select(*names)
    # a load has a key once: its number says which row of a key counts
    turn = F.split_part(F.col("load"), F.lit("-"), F.lit(1)).cast("long")
    keys = _scan(spark, root, m, [(b, one) for b, loads in open_.items() for one in loads]).select(m.key, BUCKET, "load", turn.alias("__turn"))
    kept = keys.groupBy(m.key).agg(F.max("__turn").alias("__turn"))
    if wanted is not None:
        kept = kept.join(wanted, m.key, "left_semi")
    told = keys.join(kept.withColumn("__kept", F.lit(1)), [m.key, "__turn"], "left").groupBy(BUCKET, "load")
    files = told.agg(F.count(F.lit(1)).alias("n"), F.count("__kept").alias("kept")).collect()  # a row for each file of the manifest
    whole += [(r[BUCKET], r["load"]) for r in files if r["kept"] == r["n"]]
    mixed = [(r[BUCKET], r["load"]) for r in files if 0 < r["kept"] < r["n"]]
    rows = _scan(spark, root, m, whole).select(*names)
    if not mixed:
        return rows
    return rows.unionByName(_scan(spark, root, m, mixed).withColumn("__turn", turn).join(kept, [m.key, "__turn"], "left_semi").select(*names))


def read(spark: SparkSession, root: str, keys: DataFrame | None = None) -> DataFrame:
    """The table; with ``keys`` (a frame that has the key column) the rows of
    those keys alone, from the files of their buckets."""
    m = _table(spark, root)
    names = StructType.fromJson(m.schema).names
    if keys is None:
        return _current(spark, root, m).select(*names)
    wanted = keys.select(m.key).where(F.col(m.key).isNotNull()).distinct()
    return _current(spark, root, m, _touched(wanted, m), wanted).select(*names)


def _touched(rows: DataFrame, m: Manifest) -> set[int]:
    """The buckets of the rows' keys: at most ``buckets`` small numbers."""
    return {r[0] for r in rows.select(bucket_of(m.key, m.buckets)).distinct().collect()}


# --- loads --------------------------------------------------------------------

def _parts(spark: SparkSession, m: Manifest, rows: int) -> int:
    """Into how many tasks and files a bucket of a load of ``rows`` is dealt."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")) // m.buckets, rows // (m.buckets * FILE_ROWS)))


def _dealt(m: Manifest, rows: DataFrame, by: Column, parts: int) -> DataFrame:
    """The one exchange of a load: by bucket, each in ``parts`` parts."""
    return rows.withColumn(BUCKET, bucket_of(m.key, m.buckets)).withColumn(PART, F.pmod(F.xxhash64(by), F.lit(parts))).repartition(BUCKET, PART)


def _put(spark: SparkSession, root: str, m: Manifest, rows: DataFrame) -> tuple[str, list[int]]:
    """Write dealt ``rows`` as one load: (its name, the buckets it has)."""
    name = f"{m.version + 1}-{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/data/load={name}"
    rows.select(*StructType.fromJson(m.schema).names, BUCKET).write.mode("errorifexists").option("compression", "zstd").partitionBy(BUCKET).parquet(path)
    fs, folder = _fs(spark, path)
    return name, [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder) if s.getPath().getName().startswith(f"{BUCKET}=")]


def _write(spark: SparkSession, root: str, m: Manifest, rows: DataFrame, n: int = 0) -> tuple[str, list[int]]:
    """Write ``rows``, about ``n``, as one load."""
    return _put(spark, root, m, _dealt(m, rows, F.col(m.key), _parts(spark, m, n)))


def _conform(rows: DataFrame, m: Manifest) -> list[Column]:
    """The table's columns from ``rows``, nulls for those it lacks."""
    return [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in StructType.fromJson(m.schema).fields]


def stage(batch: DataFrame) -> DataFrame:
    """The batch written once, its rows numbered: a load reads it more than
    once.  Loads stage their batches themselves unless that was done."""
    return materialize(batch.withColumn(ROW, F.monotonically_increasing_id()), "delta-batch")


def marked(batch: DataFrame) -> DataFrame:
    """Instead of ``stage``, for batches that give the same rows whenever they
    are read (files and expressions): nothing is written, a hash of all
    columns tells rows of one key and ordinal apart."""
    return batch.withColumn(ROW, F.xxhash64(*[f.name for f in batch.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]))


def keys_of(batch: DataFrame, key: str, order: str) -> DataFrame:
    """A marked or staged batch's keys and places, written once."""
    return materialize(batch.select(key, F.struct(F.col(order).alias("o"), F.col(ROW).alias("r")).alias(PLACE)), "delta-keys")


def follow(rows: DataFrame, marks: DataFrame, on: list[str], deal) -> DataFrame:
    """The rows that ``marks`` (distinct in ``on``; all its columns are of the
    result) name, the first of equal ones; both sides meet in the exchange
    ``deal`` alone, whose columns must depend on ``on``."""
    more = [c for c in marks.columns if c not in on]
    both = rows.withColumn(MARK, F.lit(1)).unionByName(marks.withColumn(MARK, F.lit(0)), allowMissingColumns=True)
    dealt, by = deal(both)
    w = Window.partitionBy(*by, *on).orderBy(MARK)
    for c in more:
        dealt = dealt.withColumn(c, F.first(c).over(w))
    return dealt.withColumn("__first", F.first(MARK).over(w)).withColumn("__n", F.row_number().over(w)) \
        .where((F.col("__first") == 0) & (F.col("__n") == 2)).drop(MARK, "__first", "__n")


def _load(spark: SparkSession, root: str, batch: DataFrame, order: str, absent_only: bool, id_col: str | None, last: bool, txn: tuple[str, int] | None, keys: DataFrame | None = None) -> Report:
    m = _table(spark, root)
    total = len(m.files())
    if _applied(m, txn):
        return Report(m.version, 0, 0, 0, 0, 0, total, True)
    staged = batch if ROW in batch.columns else stage(batch)
    keys = keys_of(staged, m.key, order) if keys is None else keys
    n_rows, n_null = keys.select(F.count(F.lit(1)), F.count_if(F.col(m.key).isNull())).first()
    # keys and ordinals alone decide; the chosen rows follow by their place
    asked = keys.where(F.col(m.key).isNotNull())
    chosen = asked.groupBy(m.key).agg((F.max if last else F.min)(PLACE).alias(PLACE))
    touched = _touched(asked, m)
    files = m.files(touched) if absent_only else []
    if files:
        stored = _scan(spark, root, m, files).select(F.col(m.key).alias("__key")).distinct()
        chosen = chosen.join(stored, F.col(m.key) == F.col("__key"), "left_anti")
    chosen = assign_ids(chosen, PLACE, start=m.next_id, id_col=id_col) if id_col else materialize(chosen, "delta-chosen")
    n_chosen = chosen.count()
    report = Report(m.version, n_rows, n_null, n_chosen, len(touched), len(files), total)
    if not n_chosen and txn is None:
        return report
    place = F.struct(F.col(order).alias("o"), F.col(ROW).alias("r")).alias(PLACE)
    rows = staged.where(F.col(m.key).isNotNull()).select(*_conform(staged, m), place)
    parts = _parts(spark, m, n_rows)
    rows = follow(rows.drop(*([id_col] if id_col else [])), chosen, [m.key, PLACE], lambda both: (_dealt(m, both, F.col(PLACE), parts), (BUCKET, PART)))
    name, buckets = _put(spark, root, m, rows) if n_chosen else ("", [])
    done = _add(spark, root, m, name, buckets, txn, n_chosen if id_col else 0)
    return replace(report, version=done.version)


def _applied(m: Manifest, txn: tuple[str, int] | None) -> bool:
    return txn is not None and m.applied.get(txn[0], -1) >= txn[1]


def _add(spark: SparkSession, root: str, m: Manifest, name: str, buckets: list[int], txn: tuple[str, int] | None, ids: int = 0) -> Manifest:
    """Commit a written load."""
    loads = {b: list(one) for b, one in m.loads.items()}
    for b in buckets:
        loads.setdefault(str(b), []).append(name)
    applied = m.applied | ({txn[0]: txn[1]} if txn is not None else {})
    return _commit(spark, root, replace(m, version=m.version + 1, loads=loads, applied=applied, next_id=m.next_id + ids))


def insert_new(spark: SparkSession, root: str, batch: DataFrame, order: str, id_col: str | None = None, txn: tuple[str, int] | None = None, keys: DataFrame | None = None) -> Report:
    """Insert the rows of ``batch`` whose key isn't stored, the first of each
    key by ``order``.  Only the key column of the touched buckets is read.
    With ``id_col`` the new rows get the ids that follow the stored ones, in
    ``order`` (unique then); the manifest keeps the next one.  ``keys``: the
    batch's ``keys_of``, where the caller has them."""
    return _load(spark, root, batch, order, True, id_col, False, txn, keys)


def upsert(spark: SparkSession, root: str, batch: DataFrame, order: str | None, txn: tuple[str, int] | None = None, rows: int = 0) -> Report:
    """Same key replaces, new key inserts; the last row of each key by
    ``order`` counts.  No stored file is read.  Without an ``order`` the
    caller vouches that no key repeats or is null: the batch is written as it
    comes, in one pass; ``rows``, about its number, says in how many files a
    bucket is written."""
    if order is not None:
        return _load(spark, root, batch, order, False, None, True, txn)
    m = _table(spark, root)
    total = len(m.files())
    if _applied(m, txn):
        return Report(m.version, 0, 0, 0, 0, 0, total, True)
    name, buckets = _write(spark, root, m, batch.select(*_conform(batch, m)), rows)
    written = _scan(spark, root, m, [(b, name) for b in buckets]).count()
    done = _add(spark, root, m, name, buckets, txn)
    return Report(done.version, written, 0, written, len(buckets), 0, total)


def compact(spark: SparkSession, root: str, min_deltas: int = 1) -> Report:
    """Write the buckets that have ``min_deltas`` deltas or more as new bases;
    the others stay as they are.  The table's rows don't change."""
    m = _table(spark, root)
    total = len(m.files())
    layered = {int(b) for b, loads in m.loads.items() if len(loads) > min_deltas}
    if not layered:
        return Report(m.version, 0, 0, 0, 0, 0, total, True)
    read_files = len(m.files(layered))
    rows = _current(spark, root, m, layered).drop(BUCKET)
    name, buckets = _write(spark, root, m, rows, rows.count())
    written = _scan(spark, root, m, [(b, name) for b in buckets]).count()
    loads = {b: ([name] if int(b) in layered else list(one)) for b, one in m.loads.items()}
    done = _commit(spark, root, replace(m, version=m.version + 1, loads=loads))
    return Report(done.version, written, 0, written, len(layered), read_files, total)
