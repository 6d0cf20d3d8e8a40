"""What several operators share: stored intermediate tables, word rules, pickling of this package."""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import scratch

SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send the functions of a module with the tasks, so executors need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and outlives executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def temporary(name: str) -> str:
    """A column name that no table read by this process has: for columns that live within one operator."""
    return f"__{_MARK}_{name}"


_MARK = uuid.uuid4().hex[:12]


def replaced(df: DataFrame, *outputs: str) -> DataFrame:
    """``df`` without the columns that an operator's outputs of the same names (in any case of letters) replace."""
    lost = {name.lower() for name in outputs}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in lost))


def ascii_lower(text: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of runs without space, tab, line feed, vertical tab, form feed, return; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


class WordHashes(dict):
    """64-bit hash of each word, kept for words seen lately."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rolling_hashes(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(ids))
    rolled = np.full(len(ids) - size + 1, size, np.uint64)
    for k in range(size):
        rolled = mix(rolled + ids[k:len(ids) - size + 1 + k])
    return rolled


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of rows that agree in the first ``keys`` integer columns; a run over several batches is several slices."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield tuple(int(column[a]) for column in columns), batch.slice(a, b - a)
