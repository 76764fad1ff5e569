"""Sessions, and the package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    conf = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_leadloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / "leadloom_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._leadloom_shipped = True
