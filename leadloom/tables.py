"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows that row rules work on in one task: some seconds of it.
TASK_ROWS = 4_000


def spread(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """df dealt over as many tasks as its rows need. A small file with many rows would else be one task, whatever is made of its rows."""
    return df.repartition(max(1, -(-df.count() // rows)))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder where it is unset and all tasks run in the driver (local tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='leadloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Intermediate tables as Parquet in the shared folder.

    Writing cuts the lineage: a lost executor costs the tasks of one step, not of all steps before it. Tables that no later
    step reads are removed with drop(); the last ones stay for the caller, who reads them lazily.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables, and let go of the shuffle files of finished steps.

        Spark removes those once the driver's garbage is collected, which a driver that mostly waits hardly ever does.
        """
        self._remove(*[df._scratch_path for df in frames])

    def clear(self) -> None:
        """Remove all tables."""
        self._remove(self.root)

    def _remove(self, *paths: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()
