"""Durable, restartable outputs of streams."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsloom.session import drop_scratch, scratch
from newsloom.streaming.keystore import KeyStore
from newsloom.streaming.manifest import Manifest

COMMIT_EVERY = "60 seconds"  # Fixed value: time between two commits of a running job.


def _start(writer, checkpoint: str, continuous: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=COMMIT_EVERY).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_stream(
    records: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", continuous: bool = False,
    **options: str,
) -> StreamingQuery:
    """Append a stream of records to a folder; a restart skips finished input.

    ``continuous`` commits every minute; otherwise all that has arrived is processed
    and the call returns.
    """
    writer = records.writeStream.format(fmt).outputMode("append").option("path", path)
    return _start(writer.options(**options), checkpoint, continuous)


def run_of(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()


def _batch_folder(path: str, checkpoint: str, batch_id: int) -> str:
    return f"{path}/run={run_of(checkpoint)}/batch_id={batch_id}"


def append_first_seen(
    records: DataFrame, path: str, checkpoint: str, key: str, delivery: str, continuous: bool = False
) -> StreamingQuery:
    """Append the first delivery of every key, once, whatever is replayed.

    A batch writes its own folder ``run=R/batch_id=N`` (R stands for the checkpoint), so
    a batch that runs again after a crash overwrites itself. Keys already stored by other batches are
    dropped by an anti-join with a key store beside the rows (``path/_keys``); stored rows are not
    read. Of a key delivered twice in one batch the row of the lowest ``delivery`` stays, of several such rows that
    with the lowest hash. Rows without a key are no repeats of each other; all are stored.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        store_first_seen(batch, batch_id, path, checkpoint, key, delivery)

    return _start(records.writeStream.foreachBatch(append), checkpoint, continuous)


def store_first_seen(batch: DataFrame, batch_id: int, path: str, checkpoint: str, key: str, delivery: str) -> None:
    """One batch of ``append_first_seen``."""
    spark, run, folder = batch.sparkSession, run_of(checkpoint), _batch_folder(path, checkpoint, batch_id)
    store = KeyStore(spark, f"{path}/_keys", batch.schema[key].dataType)
    if not store.manifest.versions():
        # rows of a time before there was a key store
        old = read_batches(spark, path, T.StructType([batch.schema[key]])).where(F.col(key).isNotNull())
        for r in old.select("run", "batch_id").distinct().collect():
            store.add(old.where((F.col("run") == r.run) & (F.col("batch_id") == r.batch_id)), key, r.run, r.batch_id)
    # The batch is read twice; without this its pages would be parsed twice.
    landed = scratch(spark, "batch")
    batch.write.parquet(landed)
    rows = spark.read.schema(batch.schema).parquet(landed).withColumn("__row", F.xxhash64(*batch.columns))
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(delivery, "__row")).alias("__first"))
    fresh = first.join(store.seen(first, key, run, batch_id), key, "left_anti").select(key, "__first.*")
    once = rows.join(fresh, [key, delivery, "__row"], "left_semi").dropDuplicates([key]).select(*batch.columns)
    once.unionByName(rows.where(F.col(key).isNull()).select(*batch.columns)).write.mode("overwrite").parquet(folder)
    store.add(spark.read.schema(batch.schema).parquet(folder).where(F.col(key).isNotNull()), key, run, batch_id)
    drop_scratch(spark, landed)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batch folders with ``run`` and ``batch_id``; empty before the first."""
    place = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    full = T.StructType(schema.fields + place)
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem.getCondition()):
            raise
        return spark.createDataFrame([], full)


def write_updates(
    updates: DataFrame, path: str, checkpoint: str, *key: str, continuous: bool = False, fold_every: int = 16
) -> StreamingQuery:
    """Store what every batch of an updating aggregate gives, in the order of commits.

    A batch writes its own folder; a manifest lists the folders in order. With ``key``, every ``fold_every``
    batches are folded into a snapshot of the newest value per key, so what a reader
    has to read is bounded by the number of keys, not by the life of the stream.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark, manifest = batch.sparkSession, Manifest(batch.sparkSession, f"{path}/_manifest")
        name = f"increments/{run_of(checkpoint)}-{batch_id}"
        entries = manifest.entries()
        if any(name == e["name"] or name in e["folded"] for e in entries):
            return                          # committed before; the same batch gives the same values
        batch.write.mode("overwrite").parquet(f"{path}/{name}")
        entries.append({"name": name, "folded": []})
        gone = []
        if key and len(entries) > fold_every:
            snapshot = f"snapshots/{uuid.uuid4().hex}"
            newest_of(spark, path, entries, batch.schema, *key).write.parquet(f"{path}/{snapshot}")
            gone = [f"{path}/{e['name']}" for e in entries]
            # batches of a snapshot are remembered while they can run again: the last one of every run
            last = {}
            for n in [m for e in entries for m in (e["folded"] or [e["name"]])]:
                last[n.rpartition("-")[0]] = n
            entries = [{"name": snapshot, "folded": list(last.values())}]
        manifest.commit(entries)
        drop_scratch(spark, *gone)

    return _start(updates.writeStream.outputMode("update").foreachBatch(store), checkpoint, continuous)


def newest_of(spark: SparkSession, path: str, entries: list[dict], schema: T.StructType, *key: str) -> DataFrame:
    """Per key the row of the latest entry that has one; the entries are in the order of commits."""
    every = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("__at", T.IntegerType())]))
    for at, entry in enumerate(entries):
        every = every.unionByName(spark.read.schema(schema).parquet(f"{path}/{entry['name']}").withColumn("__at", F.lit(at)))
    rest = [c for c in schema.fieldNames() if c not in key]
    newest = every.groupBy(*key).agg(F.max_by(F.struct(*rest), "__at").alias("__new"))
    return newest.select(*key, "__new.*").select(*schema.fieldNames())


def latest_updates(spark: SparkSession, path: str, schema: T.StructType, *key: str) -> DataFrame:
    """The value of every group that was committed last, over batches and over runs (checkpoints)."""
    return newest_of(spark, path, Manifest(spark, f"{path}/_manifest").entries(), schema, *key)


def write_committed(
    outputs: Callable[[DataFrame, int], tuple[dict[str, DataFrame], list[str]]], rows: DataFrame, path: str, checkpoint: str,
    continuous: bool = False,
) -> StreamingQuery:
    """T1 with several outputs: all that ``outputs`` makes of a batch appears with one commit, or not at all.

    ``outputs`` gives the named tables of a batch and the scratch paths they rest on. A batch that
    runs again overwrites its folders, which are the same, and is not committed twice.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark, manifest = batch.sparkSession, Manifest(batch.sparkSession, f"{path}/_manifest")
        made, paths = outputs(batch, batch_id)
        names = {name: f"{name}/{run_of(checkpoint)}-{batch_id}" for name in made}
        for name, table in made.items():
            table.write.mode("overwrite").parquet(f"{path}/{names[name]}")
        entries = manifest.entries()
        if names not in entries:
            manifest.commit([*entries, names])
        drop_scratch(spark, *paths)

    return _start(rows.writeStream.foreachBatch(store), checkpoint, continuous)


def read_committed(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    """Rows of one output of ``write_committed``: those of finished batches."""
    folders = [f"{path}/{e[name]}" for e in Manifest(spark, f"{path}/_manifest").entries() if name in e]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
