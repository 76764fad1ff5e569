"""Streams: the row-wise stages, the first lead of each e-mail, batches that are repeated."""

from leadloom import queries, rule_queries
from leadloom.leads import leads
from leadloom.streaming import batches

LEADS = "Id string, Email string, seen timestamp"


def test_first_by_email(spark, tmp_path):
    for k, rows in enumerate(([("1", "a@x.de"), ("2", "A@x.de "), ("3", ""), ("4", "")], [("5", "a@x.de"), ("6", "b@x.de"), ("7", "n/a")])):
        spark.createDataFrame(rows, "Id string, Email string").selectExpr("*", f"TIMESTAMP '2024-01-01 00:0{k}:00' AS seen").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(LEADS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second start finds everything done
        batches.write_batches(batches.first_by_email(stream, "seen"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = [r.Id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == 5 and len({"1", "2", "5"} & set(got)) == 1 and {"3", "4", "6", "7"} <= set(got)


def test_a_stream_is_cleaned_like_a_table(spark):
    sf = "/root/testdata/sf0.001"
    got, want = queries.QUERIES["streamed_clean"](spark, sf), queries.QUERIES["normalized"](spark, sf).drop("_changes")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    """A file with one block of rows was one task, whatever was made of them."""
    rows = spark.range(20_000).selectExpr("id AS c_custkey", "0 AS c_nationkey", "'x' AS c_mktsegment", "0.0D AS c_acctbal")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert leads(spark, str(tmp_path)).rdd.getNumPartitions() == 5
    assert rule_queries.QUERIES["rules_text"](spark, str(tmp_path)).rdd.getNumPartitions() == 5
