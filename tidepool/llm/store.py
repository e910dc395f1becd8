"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """A folder of its own under ``spark.checkpoint.dir`` for one call.

    Tables written here replace the lineage above them: a lost executor costs
    a re-read of shared files, not a recomputation. What is superseded is
    dropped at once; the folder itself goes when the application ends, as the
    returned DataFrames are lazy and still read from it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._seq = 0
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))
        self._fs.deleteOnExit(self._path(self.root))

    def write(self, df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> DataFrame:
        """Write df as Parquet and return the table read back."""
        self._seq += 1
        path = f"{self.root}/{self._seq:03d}-{name}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for t in tables:
            path = getattr(t, "_scratch_path", None)
            if path:
                self._fs.delete(self._path(path), True)
