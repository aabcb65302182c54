"""The driver's tables in the shapes of the catalogue, as SQL that Spark and DuckDB both accept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG = """
SELECT concat('D3C', cast(1200 + l_orderkey % 20 AS string), '-', lpad(cast(l_partkey AS string), 6, '0'),
              CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'A' ELSE 'T' END, lpad(cast(l_suppkey % 5 AS string), 3, '0')) AS entity_id,
       -180 + (l_partkey * 7919 % 3500) / 10e0 AS sw_lon, -60 + (l_suppkey * 104729 % 1150) / 10e0 AS sw_lat,
       -180 + (l_partkey * 7919 % 3500) / 10e0 AS nw_lon, -60 + (l_suppkey * 104729 % 1150) / 10e0 + (0.2e0 + l_discount) AS nw_lat,
       -180 + (l_partkey * 7919 % 3500) / 10e0 + (1 + l_quantity / 25e0) AS ne_lon, -60 + (l_suppkey * 104729 % 1150) / 10e0 + (0.2e0 + l_discount) AS ne_lat,
       -180 + (l_partkey * 7919 % 3500) / 10e0 + (1 + l_quantity / 25e0) AS se_lon, -60 + (l_suppkey * 104729 % 1150) / 10e0 AS se_lat,
       CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber * 100 END AS crop_xoff, cast(l_shipdate AS date) AS acq_date,
       l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax
FROM lineitem
"""
BOXES = """
SELECT s_suppkey AS id, (s_suppkey * 7919 % 300) / 10e0 AS x0, (s_suppkey * 104729 % 200) / 10e0 AS y0,
       (s_suppkey * 7919 % 300) / 10e0 + 1 + s_suppkey % 5 AS x1, (s_suppkey * 104729 % 200) / 10e0 + 1 + s_suppkey % 3 AS y1
FROM supplier
"""
#: One raster of a row per user and a column per day.
GRID = """
SELECT 0 AS raster_id, user_id AS row, {day} AS col, max(value) AS value FROM events GROUP BY user_id, {day}
"""
DAY = {"spark": "cast(datediff(cast(ts AS date), date '1970-01-01') AS bigint)", "duckdb": "cast(datediff('day', date '1970-01-01', cast(ts AS date)) AS bigint)"}
MATCHES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 7 AS image, l_discount * 100 + l_tax AS residual,
       l_quantity * 10 - 20 AS px_col, (l_partkey * 31 % 450) - 10e0 AS px_row
FROM lineitem
"""


def grid(engine: str) -> str:
    return GRID.format(day=DAY[engine])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapt(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """``sql`` over the named tables, without leaving views behind."""
    return spark.sql(" ".join(f"{{{t}}}" if t in tables else t for t in sql.split()), **{t: load(spark, sf_dir, t) for t in tables})
