"""What the text operators share: table access, checkpoints and Arrow batch plumbing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.graph import checkpointed
from gridloom.ship import ship

#: Rows of one Arrow batch that goes to Python: whole texts are long, so few of them.
BATCH_ROWS = 1000

__all__ = ["by_batch", "checkpointed", "give_back", "ready_for_python", "table", "words"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_for_python(spark: SparkSession) -> None:
    """Ships this package and bounds the memory of a Python worker: a batch holds at most BATCH_ROWS texts."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def by_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """function over the Arrow batches of df; it gets and gives whole record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        del batches
        give_back()

    ready_for_python(df.sparkSession)
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system: workers outlive their tasks, and what they hold is missing in the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def words(text: Column) -> Column:
    """The words of a text: maximal runs of what is neither a space nor one of the characters 9 to 13."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
