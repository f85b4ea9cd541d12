"""Rasters and other objects derived from the driver's tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 125


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raster of orders: z in cents, whether it's missing (often, or rarely), a zone and a date."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(k >= 0, "dem").alias("raster_id"),  # no literal: Spark would drop it from join keys
        (k / WIDTH).cast("int").alias("r"),
        (k % WIDTH).cast("int").alias("c"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("z"),
        (F.col("o_orderstatus") == "P").alias("gap"),
        (k % 37 == 0).alias("hole"),
        (F.col("o_custkey") % 25).cast("int").alias("zone"),
        F.col("o_orderdate").alias("ts"),
        k.alias("o_orderkey"),
    )


#: The same in SQL, as the first common table of a query.
GRID_SQL = """WITH g AS (SELECT CAST(o_orderkey // 125 AS INTEGER) AS r, CAST(o_orderkey % 125 AS INTEGER) AS c, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS z,
  o_orderstatus = 'P' AS gap, o_orderkey % 37 = 0 AS hole, CAST(o_custkey % 25 AS INTEGER) AS zone, o_orderdate AS ts, o_orderkey FROM orders),
n AS (SELECT max(r) + 1 AS n_r, max(c) + 1 AS n_c FROM g)"""
