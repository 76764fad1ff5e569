"""The row-wise stages over a stream of leads, batch by batch; and the first lead of each e-mail within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from leadloom.functions import sqltext as F
from leadloom.functions.text import normalized_email
from leadloom.operators.normalize import normalize
from leadloom.operators.validate import validate


def clean_stream(stream: DataFrame, mx: DataFrame | None = None) -> DataFrame:
    """validate() and normalize() hold no state and work on a stream as on a table."""
    spark = stream.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)  # a batch may be one file
    return normalize(validate(stream.repartition(tasks), mx).drop("_issues")).drop("_changes")


def first_by_email(stream: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """The first lead of each e-mail within the watermark; blank e-mails never meet."""
    key = F.when(normalized_email(F.col("Email")) == "", F.concat(F.lit("id:"), F.col("Id"))).otherwise(normalized_email(F.col("Email")))
    return stream.withWatermark(time, late).withColumn("_key", key).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def write_batches(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Each batch under its own number, so that a repeated batch replaces itself."""
    return stream.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
