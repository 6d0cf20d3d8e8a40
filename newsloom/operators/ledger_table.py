"""A ledger that grows by appends and answers from a snapshot.

Every append is a folder of attempts; a manifest lists the folders. Every ``fold_every`` appends the
state per key (last attempt, first time, number of attempts) is folded into a new snapshot, so the state of
a ledger is read from one snapshot and few late folders, however long it has run. Attempts are never
rewritten; the whole history can still be read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.ledger import key_state, merged_state, status_of
from newsloom.session import drop_scratch
from newsloom.streaming.manifest import Manifest

_STATE = "url string, last decimal(38,0), first_micros long, attempts long"


class LedgerTable:
    def __init__(self, spark: SparkSession, path: str, fold_every: int = 16):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        self.manifest = Manifest(spark, f"{self.path}/_manifest")

    def _parts(self) -> dict:
        found = self.manifest.entries()
        return found[0] if found else {"snapshot": None, "folded": [], "late": []}

    def append(self, attempts: DataFrame) -> None:
        """Add attempts; they count as soon as the manifest names them, all or none."""
        name = f"attempts/{uuid.uuid4().hex}"
        attempts.select(*schemas.LEDGER.fieldNames()).write.parquet(f"{self.path}/{name}")
        parts, old = self._parts(), None
        parts["late"].append(name)
        if len(parts["late"]) >= self.fold_every:
            old, snapshot = parts["snapshot"], f"state/{uuid.uuid4().hex}"
            self._state(parts).write.parquet(f"{self.path}/{snapshot}")
            parts = {"snapshot": snapshot, "folded": parts["folded"] + parts["late"], "late": []}
        self.manifest.commit([parts])
        if old:
            drop_scratch(self.spark, f"{self.path}/{old}")

    def _attempts(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schemas.LEDGER)
        return self.spark.read.schema(schemas.LEDGER).parquet(*(f"{self.path}/{n}" for n in names))

    def _state(self, parts: dict) -> DataFrame:
        late = key_state(self._attempts(parts["late"]))
        if not parts["snapshot"]:
            return late
        return merged_state(self.spark.read.schema(_STATE).parquet(f"{self.path}/{parts['snapshot']}").unionByName(late))

    def history(self) -> DataFrame:
        """All attempts."""
        parts = self._parts()
        return self._attempts(parts["folded"] + parts["late"])

    def status(self) -> DataFrame:
        """(url, attempt, ts, outcome, first_micros, attempts): the last attempt of every URL."""
        return status_of(self._state(self._parts()))

    def done(self) -> DataFrame:
        """URLs whose last attempt succeeded."""
        return self.status().where("outcome = 'ok'").select("url")
