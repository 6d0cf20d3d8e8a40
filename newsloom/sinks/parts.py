"""K2, K4, O2: archives in order, in parts below a byte limit, and proofs of both."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.session import drop_scratch
from newsloom.sinks.files import PART_BYTES

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLACK = 0.01                                # of the limit: a line more also changes how those before it are packed


class Measure:
    """Compressed size of the lines of one part, were it closed now.

    Nothing is flushed in between, as the writer flushes nothing: flushed pieces pack mixed text better than
    the whole does. The size is that of a closed copy, made only when text that is not measured yet,
    counted in full, would pass the limit: a few times per part.
    """

    def __init__(self):
        self.packer, self.out, self.size, self.open = zlib.compressobj(6, wbits=31), 0, 32, 0

    def add(self, line: bytes) -> None:
        self.out += len(self.packer.compress(line))
        self.open += len(line)

    def settle(self) -> None:
        self.size, self.open = self.out + len(self.packer.copy().flush()), 0

    def fits(self, length: int, limit: int) -> bool:
        """Whether a line of so many bytes fits; text that is not measured yet counts in full."""
        limit -= int(limit * SLACK)
        if self.size + self.open + length > limit and self.open:
            self.settle()
        return self.size + self.open + length <= limit


def _cut(limit: int):
    """Lines in order -> (part, place, value); a part ends where the next line might not fit.

    A second column names the part a line is in so far, whose lines follow each other; its parts are named after it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = f"{TaskContext.get().partitionId():06d}"
        part, place, measure = 0, 0, Measure()
        for batch in batches:
            parts, places = [], []
            heads = batch.column(1).to_pylist() if batch.num_columns > 1 else [head] * batch.num_rows
            for value, mine in zip(batch.column(0), heads):
                line = value.as_py().encode("utf-8", "surrogatepass") + b"\n"
                if mine != head:
                    head, part, place, measure = mine, 0, 0, Measure()
                elif place and not measure.fits(len(line), limit):
                    part, place, measure = part + 1, 0, Measure()
                measure.add(line)
                parts.append(f"{head}-{part:06d}")
                places.append(place)
                place += 1
            yield pa.record_batch([pa.array(parts, pa.string()), pa.array(places, pa.int64()), batch.column(0)], names=["part", "place", "value"])

    return cut


_CUT = "part string, place long, value string"


def _write(lines: DataFrame, path: str) -> None:
    """A gzip file per part, lines in order: the sort on (part, place) is the order the writer asks for."""
    ordered = lines.sortWithinPartitions("part", "place").select("part", "value")
    ordered.write.mode("append").option("compression", "gzip").partitionBy("part").text(path)


def write_parts_below(records: DataFrame, path: str, *order_by: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """K4: all records in order, as gzip JSON lines in parts of at most ``part_bytes``; returns parts above (see below).

    Rows are range-partitioned by ``order_by`` (a total order) and sorted; each task fills its parts by the
    measured compressed size of their lines. Written sizes are then checked: the compressor of the writer may
    differ, so parts above the limit are read again, all in one job, and cut at a tenth less, until none
    is left. A single record above the limit is a part of its own; only such parts are returned. Names of parts
    sort as their records do.
    """
    spark = records.sparkSession
    line = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")
    spread = records.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    _write(spread.select(line).mapInArrow(_cut(part_bytes), _CUT), path)
    limit = part_bytes
    while True:
        above = parts_above(spark, path, part_bytes)
        over = [r.path for r in above.where("records > 1").select("path").collect()]
        if not over:
            return above
        limit = limit * 9 // 10
        # a file of one part is read by one task, from its first line to its last: gzip is not split
        whole = spark.read.text(over).select("value", _part_of(F.col("_metadata.file_path")))
        _write(whole.mapInArrow(_cut(limit), _CUT), path)
        drop_scratch(spark, *over)


def _part_of(path: Column) -> Column:
    return F.regexp_extract(path, "part=([^/]+)/", 1).alias("part")


def parts_above(spark: SparkSession, path: str, part_bytes: int) -> DataFrame:
    """(path, part, bytes, records) of parts above a limit; sizes come from the listing, records of these alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    over = files.where(F.col("length") > part_bytes).select("path", F.col("length").alias("bytes"))
    paths = [r.path for r in over.collect()]
    found = spark.createDataFrame([], "path string, part string, records long")
    if paths:
        found = spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("records"))
        found = found.withColumn("part", _part_of(F.col("path")))
    return over.join(found, "path")


def order_certificate(rows: DataFrame, *order_by: str) -> DataFrame:
    """O2, K2: per file of an archive its member record: name, records, first and last key, and whether it is in order.

    ``rows`` is a file-based DataFrame with ``ingest_pos`` (see ``read_articles``). ``in_order`` is false where a
    record of the file comes before its predecessor, ``follows`` where the file begins before
    the file ahead of it ends. The archive is in order when both hold for every member.
    """
    key = F.struct(*order_by)
    inside = Window.partitionBy("file").orderBy("ingest_pos")
    keyed = rows.select(F.col("ingest_pos.file").alias("file"), "ingest_pos", key.alias("key"))
    back = keyed.withColumn("back", F.coalesce(F.col("key") < F.lag("key").over(inside), F.lit(False)))
    members = back.groupBy("file").agg(
        F.count("*").alias("records"), F.min_by("key", "ingest_pos").alias("first"), F.max_by("key", "ingest_pos").alias("last"),
        F.count_if("back").alias("inversions"),
    )
    # one row per file
    ahead = F.lag("last").over(Window.orderBy("file"))
    return members.withColumns({
        "in_order": F.col("inversions") == 0, "follows": F.coalesce(F.col("first") >= ahead, F.lit(True)),
    })


def is_in_order(rows: DataFrame, *order_by: str) -> DataFrame:
    """One row: members, records, first and last key, ``ordered``."""
    return order_certificate(rows, *order_by).agg(
        F.count("*").alias("members"), F.sum("records").alias("records"), F.min_by("first", "file").alias("first"),
        F.max_by("last", "file").alias("last"), F.coalesce(F.bool_and(F.col("in_order") & F.col("follows")), F.lit(True)).alias("ordered"),
    )
