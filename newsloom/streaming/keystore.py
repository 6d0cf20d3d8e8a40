"""Keys that earlier batches have stored, kept apart from the rows that hold them.

Each batch adds one small file of its new keys. Every ``fan`` such files are merged into a
segment cut by hash buckets, every ``fan`` segments into a larger one, and so on. A batch reads the few
files that are not merged yet and, of each segment, only the buckets its own keys fall
into; pages and texts are never read again. Every key keeps the batch it came
from, so a batch that runs again does not take its own keys for those of another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import drop_scratch
from newsloom.streaming.manifest import Manifest


class KeyStore:
    def __init__(self, spark: SparkSession, folder: str, kind: T.DataType, buckets: int = 64, fan: int = 8):
        self.spark, self.folder, self.buckets, self.fan = spark, folder.rstrip("/"), buckets, fan
        self.manifest = Manifest(spark, f"{self.folder}/manifest")
        self.schema = T.StructType([
            T.StructField("key", kind), T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
        ])

    def bucket(self, column: str):
        return F.pmod(F.xxhash64(F.col(column)), F.lit(self.buckets)).cast("int")

    def _rows(self, entries: list[dict], touched: set[int] | None = None) -> DataFrame:
        """Keys of entries, in one read; of segments only those in the buckets ``touched``."""
        paths = []
        for entry in entries:
            base = f"{self.folder}/{entry['name']}"
            if entry["level"]:
                paths += [f"{base}/bucket={b}" for b in entry["buckets"] if touched is None or b in touched]
            else:
                paths.append(base)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def seen(self, keys: DataFrame, column: str, run: str, batch_id: int) -> DataFrame:
        """(``column``): keys that other batches have stored, as far as they can be among ``keys``."""
        entries = self.manifest.entries()
        touched = None
        if any(e["level"] for e in entries):
            touched = {r[0] for r in keys.select(self.bucket(column)).distinct().collect()}    # at most ``buckets`` rows
        mine = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        return self._rows(entries, touched).where(~mine).select(F.col("key").alias(column))

    def add(self, keys: DataFrame, column: str, run: str, batch_id: int) -> None:
        """Store the new keys of a batch; done twice it is as done once."""
        name = f"keys/{run}-{batch_id}"
        rows = keys.select(F.col(column).alias("key"), F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        entries = self.manifest.entries()
        if all(e["name"] != name and name not in e["merged"] for e in entries):
            self._merge([*entries, {"name": name, "level": 0, "merged": [], "buckets": []}])

    def _merge(self, entries: list[dict]) -> None:
        """Commit the entries; of every level that is full, all of its entries as one of the next."""
        level, gone = 0, []
        while len(full := [e for e in entries if e["level"] == level]) >= self.fan:
            name = f"segments/{level + 1}-{uuid.uuid4().hex}"
            cut = self._rows(full).withColumn("bucket", self.bucket("key"))
            cut.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
            found = sorted(r[0] for r in cut.select("bucket").distinct().collect())
            merged = [n for e in full for n in (e["merged"] or [e["name"]])]
            entries = [e for e in entries if e["level"] != level] + [{"name": name, "level": level + 1, "merged": merged, "buckets": found}]
            gone += [f"{self.folder}/{e['name']}" for e in full]
            level += 1
        self.manifest.commit(entries)
        drop_scratch(self.spark, *gone)
