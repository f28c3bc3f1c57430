"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Skewed tenants and subjects are split at run time, even where the split
    # costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keys of past deliveries are kept on local disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Lists of subjects and buckets reach the files' statistics value by value, not as one range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # A repeated JSON key keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Most bytes of an exchange or of a file that one task gets. The rows that become of them are many times as large in
#: the maps and sorts of the task, so this bounds its memory; a session's own smaller setting stands.
TASK_BYTES = 16 << 20
TASK_SETTINGS = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
#: What opening a file counts as: a task still reads up to 32 small files, so a landing of many polls stays few files.
OPEN_BYTES = TASK_BYTES // 32
OPEN_COST = "spark.sql.files.openCostInBytes"
#: Pieces that an exchange is cut into at least, before adaptive execution puts small ones together again.
LEAST_PIECES = 200
PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options of ``SETTINGS`` on the session, and bound what one task gets."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in (*((key, TASK_BYTES) for key in TASK_SETTINGS), (OPEN_COST, OPEN_BYTES)):
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    if int(spark.conf.get(PIECES, None) or spark.conf.get("spark.sql.shuffle.partitions")) < LEAST_PIECES:
        spark.conf.set(PIECES, str(LEAST_PIECES))
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of this machine is used only in local mode with the setting unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ebbsync-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_root(spark)}/ebbsync/{name}-{uuid.uuid4().hex}"


def delete_dir(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``: computed once, and kept when executors are lost."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that are deleted together when the scope ends.

    What is lazy and reads them has to be written, or collected, inside the scope.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(work_dir(self.spark, name))
        return written(df, self.paths[-1])

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *failure) -> None:
        for path in self.paths:
            delete_dir(self.spark, path)


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder that is deleted afterwards."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    try:
        yield written(df, path)
    finally:
        delete_dir(spark, path)
