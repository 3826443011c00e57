"""A store dealt into buckets by id, with a log of its commits.

* **Buckets.** Every folder of rows is a bucketed, sorted Parquet table: one file per bucket of ``trade_id``. An append deals its own
  rows into the same buckets and joins folder by folder, bucket by bucket; nothing of the store is shuffled or broadcast.
* **Log.** ``log/version=<n>`` lists what the store consists of: its folders with rows, volume and digests, and the last batch of
  each writer. Readers take the newest version, so rows and totals appear together, and a batch that broke off was never there.
* **Compaction.** When an append leaves more than ``MOST_FOLDERS`` folders the small ones are written as one. Folders grow
  geometrically, so a row is rewritten a logarithmic number of times. Old folders serve running readers until ``expire``.
* **Digests.** Per bucket the log has the number of rows and order-free sums over the ids. Two stores of equal
  bucket counts are compared by digests, and ids are read only where they differ.

A store has one active writer at a time. A writer's batch numbers rise: one at or below its last is a batch tried again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import notional
from twinledger.operators.store import first_copies, storable
from twinledger.schema import STATUS_DRIFT, STATUS_IN_PARITY, STORE, TRADE_COLUMNS

BUCKETS = 16
MOST_FOLDERS = 8
KEPT_VERSIONS = 4

_SUM = T.DecimalType(38, 0)
LOG = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # store, folder or writer
        T.StructField("folder", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("volume", T.DecimalType(36, 2)),
        T.StructField("digests", T.ArrayType(T.StructType(
            [T.StructField("bucket", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("ids", _SUM), T.StructField("mixed", _SUM)]
        ))),
    ]
)


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}/log"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*LOG.fields, T.StructField("version", T.LongType())])
    return spark.read.schema(schema).parquet(_log_path(path))


class _State:
    """One version of a store: what the log says. It has a row per folder and per writer, a bounded number of either."""

    def __init__(self, spark: SparkSession, path: str, as_of: int | None = None):
        log = _versions(spark, path)
        if as_of is None:
            as_of = log.agg(F.max("version")).first()[0]
        rows = log.filter(F.col("version") == as_of).collect()
        if not rows:
            raise ValueError(f"{path} has no version {as_of}")
        self.spark, self.path, self.version = spark, path.rstrip("/"), as_of
        self.buckets = next(r.buckets for r in rows if r.kind == "store")
        self.folders = [r for r in rows if r.kind == "folder"]
        self.last = {r.writer: r.batch_id for r in rows if r.kind == "writer"}

    def commit(self, folders: list[Row], last: dict[str, int]) -> None:
        """The next version. Its one file appears by a rename; whatever a broken commit left under the number goes."""
        rows = [("store", None, None, None, self.buckets, None, None, None)]
        rows += [("folder", f.folder, f.writer, f.batch_id, None, f.trade_count, f.volume, f.digests) for f in folders]
        rows += [("writer", None, w, b, None, None, None, None) for w, b in last.items()]
        version = self.spark.createDataFrame(rows, LOG).coalesce(1)
        version.write.mode("overwrite").parquet(f"{_log_path(self.path)}/version={self.version + 1}")

    def folder(self, name: str) -> DataFrame:
        """A folder as the bucketed table it was written as; any session can declare it anew."""
        table = _table_name(self.path, name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORE.fields)
        place = f"{self.path}/data/{name}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (trade_id) SORTED BY (trade_id) "
            f"INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        return self.spark.table(table)

    def write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        dealt = rows.select(*STORE.fieldNames()).repartition(self.buckets, "trade_id")
        writer = dealt.write.bucketBy(self.buckets, "trade_id").sortBy("trade_id").option("path", f"{self.path}/data/{name}")
        writer.format("parquet").saveAsTable(_table_name(self.path, name))
        return name

    def measured(self, name: str, writer: str | None, batch_id: int | None) -> Row:
        """A folder's entry in the log, taken from what was written."""
        per_bucket = self.folder(name).groupBy(bucket_of(self.buckets).alias("bucket")).agg(
            F.count("*").alias("rows"), F.sum(notional()).alias("volume"), *_id_sums()
        )
        found = per_bucket.collect()  # a row per bucket
        digests = [(r.bucket, r.rows, r.ids, r.mixed) for r in found]
        return Row(
            folder=name, writer=writer, batch_id=batch_id, trade_count=sum(r.rows for r in found),
            volume=sum((r.volume for r in found), start=0), digests=digests,
        )


def _table_name(path: str, folder: str) -> str:
    return f"ledger_{hashlib.sha256(path.encode()).hexdigest()[:12]}_{folder}"


def bucket_of(buckets: int, trade_id: str = "trade_id") -> Column:
    """The bucket that Spark's writer puts an id into."""
    return F.pmod(F.hash(trade_id), F.lit(buckets))


def _id_sums() -> list[Column]:
    """Two sums over an id's hashes: sets of equal size and equal sums are taken to be equal."""
    return [
        F.sum(F.xxhash64("trade_id").cast(_SUM)).cast(_SUM).alias("ids"),
        F.sum(F.xxhash64(F.lit(1), "trade_id").cast(_SUM)).cast(_SUM).alias("mixed"),
    ]


def create(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """A new store without rows, at version 0."""
    first = [("store", None, None, None, buckets, None, None, None)]
    spark.createDataFrame(first, LOG).coalesce(1).write.parquet(f"{_log_path(path)}/version=0")


def version(spark: SparkSession, path: str) -> int:
    return _State(spark, path).version


def read(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The store now, or as it was at a version."""
    state = _State(spark, path, as_of)
    rows = spark.createDataFrame([], STORE)
    for entry in state.folders:
        rows = rows.unionByName(state.folder(entry.folder))
    return rows


def totals(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """``trade_count`` and ``volume``, from the log alone."""
    folders = _state_rows(spark, path, as_of).filter("kind = 'folder'")
    return folders.agg(
        F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trade_count"), F.coalesce(F.sum("volume"), F.lit(0)).alias("volume")
    )


def _state_rows(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    log = _versions(spark, path)
    return log.filter(F.col("version") == (log.agg(F.max("version")).first()[0] if as_of is None else as_of))


def new_trades(firsts: DataFrame, state: _State) -> DataFrame:
    """Trades whose ids no folder holds. The batch is shuffled once, into the store's buckets."""
    new = firsts.repartition(state.buckets, "trade_id")
    for entry in state.folders:
        new = new.join(state.folder(entry.folder).select("trade_id").hint("merge"), "trade_id", "left_anti")
    return new


def append(trades: DataFrame, path: str, writer: str, batch_id: int, order_by: list[str] | None = None) -> int:
    """Add the trades whose ids are new, as one commit, and return how many they were.

    The first copy in ``order_by`` wins within a batch. A batch that is already in the log adds nothing and
    returns what it added then, or 0 if it has been compacted since. A batch that broke off has left only files that no version names.
    """
    spark = trades.sparkSession
    state = _State(spark, path)
    if batch_id <= state.last.get(writer, -1):
        return sum(f.trade_count for f in state.folders if (f.writer, f.batch_id) == (writer, batch_id))
    firsts = first_copies(storable(trades), order_by).select(*TRADE_COLUMNS)
    rows = new_trades(firsts, state).withColumns(
        {"created_at": F.current_timestamp(), "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")}
    )
    added = state.measured(state.write(rows), writer, batch_id)
    folders = [*state.folders, added] if added.trade_count else state.folders
    state.commit(folders, {**state.last, writer: batch_id})
    if len(folders) > MOST_FOLDERS:
        compact(spark, path)
    return added.trade_count


def compact(spark: SparkSession, path: str) -> int:
    """Write small folders as one, in a commit of its own; returns how many went into it."""
    state = _State(spark, path)
    merged: list[Row] = []
    size = 0
    for entry in sorted(state.folders, key=lambda f: f.trade_count):
        if len(merged) >= 2 and entry.trade_count > size:
            break
        merged.append(entry)
        size += entry.trade_count
    if len(merged) < 2:
        return 0
    rows = state.folder(merged[0].folder)
    for entry in merged[1:]:
        rows = rows.unionByName(state.folder(entry.folder))
    whole = state.measured(state.write(rows), None, None)
    names = {m.folder for m in merged}
    state.commit([f for f in state.folders if f.folder not in names] + [whole], state.last)
    return len(merged)


def expire(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Delete versions before the last ``keep``, and folders that no kept version names; returns the number of either."""
    log = _versions(spark, path)
    newest = log.agg(F.max("version")).first()[0]
    kept = log.filter(F.col("version") > newest - keep)
    named = {r[0] for r in kept.filter("kind = 'folder'").select("folder").distinct().collect()}
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for child in system.listStatus(files.Path(root, "log")):
        name = child.getPath().getName()
        if name.startswith("version=") and int(name.split("=")[1]) <= newest - keep:
            gone += system.delete(child.getPath(), True)
    data = files.Path(root, "data")
    for child in system.listStatus(data) if system.exists(data) else []:
        name = child.getPath().getName()
        if name not in named:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(path.rstrip('/'), name)}")
            gone += system.delete(child.getPath(), True)
    return gone


def bucket_digests(spark: SparkSession, path: str) -> DataFrame:
    """``bucket``, ``rows`` and the sums over its ids, of the whole store: one row per bucket that has rows, from the log."""
    per_folder = _state_rows(spark, path).filter("kind = 'folder'").select(F.inline("digests"))
    return per_folder.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("ids").cast(_SUM).alias("ids"), F.sum("mixed").cast(_SUM).alias("mixed"))


def differing_buckets(spark: SparkSession, one: str, other: str) -> DataFrame:
    """Buckets whose ids differ between two stores, without reading an id."""
    counts = {_State(spark, p).buckets for p in (one, other)}
    if len(counts) > 1:
        raise ValueError(f"stores of {sorted(counts)} buckets cannot be compared by bucket")
    a, b = bucket_digests(spark, one).alias("a"), bucket_digests(spark, other).alias("b")
    both = a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full")
    same = (F.col("a.rows") == F.col("b.rows")) & (F.col("a.ids") == F.col("b.ids")) & (F.col("a.mixed") == F.col("b.mixed"))
    return both.filter(~F.coalesce(same, F.lit(False))).select(F.coalesce("a.bucket", "b.bucket").alias("bucket"))


def _ids_in(state: _State, buckets: list[int]) -> DataFrame:
    """Ids of some buckets; the files of the others are not opened."""
    ids = state.spark.createDataFrame([], "trade_id string")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c\d+", 1).cast("int")
    for entry in state.folders:
        ids = ids.unionByName(state.folder(entry.folder).filter(number.isin(buckets)).select("trade_id"))
    return ids


def missing_ids(spark: SparkSession, legacy: str, cloud: str) -> DataFrame:
    """Ids in the legacy store that the cloud store lacks, looked for in differing buckets only."""
    buckets = [r[0] for r in differing_buckets(spark, legacy, cloud).collect()]  # at most one per bucket
    ids = _ids_in(_State(spark, legacy), buckets)
    return ids.join(_ids_in(_State(spark, cloud), buckets), "trade_id", "left_anti")


def parity(spark: SparkSession, legacy: str, cloud: str) -> DataFrame:
    """One row from the two logs: counts, volumes, whether the totals agree, whether the ids do too, and a status that asks for both."""
    a = totals(spark, legacy).select(F.col("trade_count").alias("legacy_count"), F.col("volume").alias("legacy_volume"))
    b = totals(spark, cloud).select(F.col("trade_count").alias("cloud_count"), F.col("volume").alias("cloud_volume"))
    apart = differing_buckets(spark, legacy, cloud).agg((F.count("*") == 0).alias("same_ids"))
    row = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(apart))  # one row each
    same = (F.col("legacy_count") == F.col("cloud_count")) & (F.col("legacy_volume") == F.col("cloud_volume"))
    return row.withColumn("same_totals", same).withColumn(
        "status", F.when(same & F.col("same_ids"), STATUS_IN_PARITY).otherwise(STATUS_DRIFT)
    )
