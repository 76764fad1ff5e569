"""A table of leads made from the customer table, by one SQL text that Spark and other engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadloom.tables import spread

LEADS_SQL = """SELECT
  concat(CASE WHEN c.k % 10 = 9 THEN 'DUPE' ELSE '00Q' END, lpad(CAST(c.k AS STRING), 6, '0')) AS Id,
  CASE WHEN c.k % 41 = 0 THEN 'Test' WHEN c.k % 10 = 9 THEN upper(c.fn) ELSE c.fn END AS FirstName,
  CASE WHEN c.k % 37 = 0 THEN '' ELSE c.ln END AS LastName,
  CASE WHEN c.k % 11 = 0 THEN '' WHEN c.k % 13 = 0 THEN 'not-an-email'
       WHEN c.k % 17 = 0 THEN concat(lower(c.fn), '@example.com')
       ELSE concat(lower(c.fn), '.', CAST(c.b AS STRING), '@', CASE WHEN c.b % 3 = 0 THEN 'gmail.com' ELSE 'acme.com' END) END AS Email,
  CASE WHEN c.k % 7 = 0 THEN '' WHEN c.k % 19 = 0 THEN '000-000-000'
       WHEN c.k % 20 IN (0, 1) THEN concat('206-555-', lpad(CAST(CAST(floor(c.k / 20.0) AS BIGINT) % 5000 AS STRING), 4, '0'))
       WHEN c.k % 20 IN (4, 6) THEN concat('206-556-', lpad(CAST(CAST(floor(c.k / 20.0) AS BIGINT) % 5000 AS STRING), 4, '0'))
       ELSE concat('+1 31', CAST(2 + CAST(floor(c.b / 10000.0) AS BIGINT) % 5 AS STRING), ' 555 ', lpad(CAST(c.b % 10000 AS STRING), 4, '0')) END AS Phone,
  CASE WHEN c.k % 23 = 0 THEN 'n/a' WHEN c.b % 2 = 0 THEN 'Acme Corp' ELSE 'PROCTER AND GAMBLE' END AS Company,
  CASE c.b % 4 WHEN 0 THEN 'sdr' WHEN 1 THEN 'VP Sales' WHEN 2 THEN 'Director | Security' ELSE '' END AS Title,
  CASE c.b % 5 WHEN 0 THEN 'https://www.acme.com/x' WHEN 1 THEN 'gmail.com' WHEN 2 THEN 'linkedin.com' ELSE '' END AS Website,
  lower(c.seg) AS Industry,
  CASE c.nk % 3 WHEN 0 THEN 'usa' WHEN 1 THEN '' ELSE 'UK' END AS Country,
  c.k AS row_order
FROM (SELECT d.k, d.b, d.seg, d.nk,
  CASE d.b % 6 WHEN 0 THEN 'Jane' WHEN 1 THEN 'Dave' WHEN 2 THEN 'David' WHEN 3 THEN 'Hans' WHEN 4 THEN 'J' ELSE 'Maya' END AS fn,
  concat(CASE d.b % 7 WHEN 0 THEN 'Doe' WHEN 1 THEN 'Büchert' WHEN 2 THEN 'Smith' WHEN 3 THEN 'Ng' WHEN 4 THEN 'Brooks' WHEN 5 THEN 'Patel' ELSE 'Bailey' END,
    chr(CAST(97 + CAST(floor(d.b / 7.0) AS BIGINT) % 26 AS INT)), chr(CAST(97 + CAST(floor(d.b / 182.0) AS BIGINT) % 26 AS INT))) AS ln
  FROM (SELECT c_custkey AS k, c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END AS b,
               c_mktsegment AS seg, c_nationkey AS nk FROM {customer}) d) c"""


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LEADS_SQL, customer=spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")))
