"""What a folder of batch outputs consists of, in the order in which it was committed.

A manifest is a list of entries, stored as one small JSON file per version. A version
appears by a rename and is never changed, so a reader sees a commit whole or not at all, and the
order of commits is the order of versions, whatever clocks say. One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

KEEP_VERSIONS = 3


class Manifest:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at = self._path(self.folder)
        if not self._fs.exists(at):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(at))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())

    def _file(self, version: int):
        return self._path(f"{self.folder}/{version:012d}.json")

    def entries(self) -> list[dict]:
        """Entries of the newest version; none before the first commit."""
        found = self.versions()
        if not found:
            return []
        stream = self._fs.open(self._file(found[-1]))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def commit(self, entries: list[dict]) -> None:
        found = self.versions()
        version = found[-1] + 1 if found else 1
        draft = self._path(f"{self.folder}/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(json.dumps(entries).encode())
        finally:
            out.close()
        if self._fs.exists(self._file(version)) or not self._fs.rename(draft, self._file(version)):
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.folder}: version {version} was written by another writer")
        for old in found[:-KEEP_VERSIONS]:
            self._fs.delete(self._file(old), False)
