"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the folder of spark.checkpoint.dir, with its lineage cut, and the estimate of its size too.

    A join's estimated size is the product of its sides', so that estimates handed on from round to round would soon have
    millions of digits; adaptive execution goes by measured sizes.  The files go when nothing refers to them any longer.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    conf = context._jsc.sc().conf()
    if not conf.contains(CLEAN):
        conf.set(CLEAN, "true")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or local_folder(context.master))
    written = df.checkpoint(eager=True)
    plain = spark._jsparkSession.internalCreateDataFrame(written._jdf.queryExecution().toRdd(), written._jdf.schema(), False)
    return DataFrame(plain, spark)


def local_folder(master: str) -> str:
    """A temporary folder, which only a driver that runs all tasks itself can share with them."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def components(edges: DataFrame) -> DataFrame:
    """node, root: of every node of the edges (a, b), the smallest node that edges lead to.

    The least neighbours are written before they're joined, so that the join can split the edges of a node that very many have.
    """
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        # Large star: what is larger than a node moves to the smallest of the node and its neighbours.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        large = checkpointed(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and what is smaller than it move to the smallest of them.
        least = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        stars = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))
        edges = checkpointed(large.join(least, "a").select(F.explode(stars).alias("e")).select("e.*").filter("a <> b").distinct())
        new = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if new == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
