"""Pages, posts and attempts arriving as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATCH_UP_BATCHES = 16  # Fixed value: batches at most of a run that processes what has arrived and ends.


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    files_per_trigger: int = 1000, **options: str,
) -> DataFrame:
    """Files of a folder in the order they appear; what was read is in the checkpoint."""
    return (
        spark.readStream.schema(schema).format(fmt)
        .option("maxFilesPerTrigger", files_per_trigger).options(**options).load(path)
    )


def files_per_batch(spark: SparkSession, path: str, files_per_trigger: int) -> int:
    """Files a batch takes in a run that ends: ``files_per_trigger``, and more where the folder holds so many
    that ``CATCH_UP_BATCHES`` of them would not do. A batch costs some seconds whatever it reads, so
    a long backlog is read in larger batches, not in more of them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    landed = sum(fs.getContentSummary(s.getPath()).getFileCount() for s in fs.globStatus(at) or ())
    return max(files_per_trigger, -(-landed // CATCH_UP_BATCHES))
