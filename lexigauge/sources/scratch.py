"""Intermediate tables in the folder the cluster shares, so that they outlive lost executors."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of rows that a task hands to Python at once in `small_batches`. Spark's own figure is 64 MB.
BATCH_BYTES = 8 << 20

_local_dir: str | None = None
_written: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, or a temporary folder where the whole session runs on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="lexigauge-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def new_path(spark: SparkSession, name: str) -> str:
    folder = f"{scratch_dir(spark)}/lexigauge-{uuid.uuid4().hex}"
    _written.append(folder)
    return f"{folder}/{name}"


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """Write `df` once and read it back: later jobs scan columns they need instead of recomputing.

    `schema` is the one to read with, if it is not that of `df`: a type of its own in place of how it is stored.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema if schema is None else schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile goes to Python BATCH_BYTES at a time.

    For rows with long arrays: JVM and worker both hold a batch, with room to grow, outside the heap, and every core has one of each.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this program. Results that still read them stop working."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        folder.getFileSystem(hadoop).delete(folder, True)
