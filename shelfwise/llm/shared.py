"""Storage shared by the driver and all executors, and small plan helpers."""

from __future__ import annotations

import pickle
import uuid
from types import SimpleNamespace

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_DEFAULT = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one is set only where none is and all tasks run in the driver's process."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(LOCAL_DEFAULT)
    return LOCAL_DEFAULT


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go from the executors' disks.

    Spark deletes them once the driver's JVM has collected the plans that made
    them, which a driver with free memory puts off until the disks are full.
    """
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again, and the shuffle files of the jobs so far."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    sc = df.sparkSession.sparkContext
    for folder in folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    sweep(df.sparkSession)


class Sent:
    """A broadcast object whose classes travel with it: executors need no copy of this package."""

    def __init__(self, spark: SparkSession, value):
        self.held, self.here = spark.sparkContext.broadcast(cloudpickle.dumps(value)), SimpleNamespace()

    def __getstate__(self):
        return self.held

    def __setstate__(self, held):
        self.held, self.here = held, SimpleNamespace()

    @property
    def value(self):
        if not hasattr(self.here, "value"):
            self.here.value = pickle.loads(self.held.value)
        return self.here.value


def let(value: Column, body) -> Column:
    """Bind a value once for use inside lambdas, which would compute it again for each element."""
    return F.transform(F.array(value), body)[0]


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_rest(column: str, modulus: int) -> Column:
    """crc32 of the identifier's decimal text, modulo; a null identifier counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))
