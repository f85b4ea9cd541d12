"""Sources and sinks: rasters as cells, tables of features, parameters, models, reports and listings of files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.missing import to_sentinel
from gridloom.schema import FEATURES, KEY, NODATA, RASTER, ROW, TRAINING
from gridloom.ship import ship
from gridloom.sources.geotiff import tiff_blocks, tiff_metadata

#: Rows of a raster in a chunk of the windowed scan.
CHUNK_ROWS = 500


# Rasters in cell form -------------------------------------------------------------------------------------------------


def read_bands(spark: SparkSession, path: str, bands: list[str] | None = None, rasters: list[str] | None = None) -> DataFrame:
    """Cells of a wide raster table; bands and rasters are pruned by the scan."""
    df = spark.read.parquet(path)
    if rasters is not None:
        df = df.filter(F.col(RASTER).isin(rasters))
    return df if bands is None else df.select(*KEY, *bands)


def chunks(df: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """df with the number of the row chunk of each cell."""
    return df.withColumn("chunk", F.floor(F.col(ROW) / rows).cast("int"))


def write_bands(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cells with all bands side by side, partitioned by raster; descriptions are kept as column metadata."""
    described = df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata or {"description": f.name}) for f in df.schema])
    described.write.mode(mode).partitionBy(RASTER).parquet(path)


def write_single_band(df: DataFrame, value: str, path: str, nodata: float = NODATA) -> None:
    """One band, as float with a sentinel."""
    df.select(*KEY, to_sentinel(F.col(value), nodata).cast("float").alias(value), F.lit(value).alias("band")).write.mode("overwrite").partitionBy(RASTER, "band").parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Rewrites a table that df may read: written beside it first, then moved into its place.

    The old table goes last; if it can't be moved away, or the new one not into its place, it stays or is put back and an error is raised.
    """
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staging, old = fs.Path(path.rstrip("/") + "__new"), fs.Path(path.rstrip("/") + "__old")
    df.write.mode("overwrite").parquet(staging.toString())
    if not system.exists(target) and system.exists(old) and not system.rename(old, target):  # left by a run that was cut off
        raise OSError(f"cannot put {old.toString()} back")
    system.delete(old, True)
    there = system.exists(target)
    if there and not system.rename(target, old):
        raise OSError(f"cannot move {path} away; the new table is {staging.toString()}")
    if not system.rename(staging, target):
        back = there and system.rename(old, target)
        raise OSError(f"cannot move the new table into {path}; " + ("the old one is back" if back or not there else f"the old one is {old.toString()}"))
    system.delete(old, True)


# GeoTIFF --------------------------------------------------------------------------------------------------------------


def read_tiffs(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """(raster_id, band, r, c, value) of the GeoTIFF files below a path; raster_id is the file's name without its ending.

    A file is read whole, then decoded block by block.
    """

    def run(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in files:
            for name, data in zip(pdf["name"], pdf["content"], strict=True):
                for first, top, left, block in tiff_blocks(data):
                    r, c = np.meshgrid(top + np.arange(block.shape[1]), left + np.arange(block.shape[2]), indexing="ij")
                    for k, band in enumerate(block, first + 1):
                        for a in range(0, len(band), CHUNK_ROWS):
                            part = slice(a, a + CHUNK_ROWS)
                            yield pd.DataFrame({RASTER: name, "band": k, "r": r[part].ravel(), "c": c[part].ravel(), "value": band[part].ravel().astype(float)})

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    named = files.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("name"), "content")
    return named.mapInPandas(run, f"{RASTER} string, band int, r int, c int, value double")


def read_tiff_metadata(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """A row of metadata for each file: the model of gridloom.schema.METADATA without band names."""

    def run(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in files:
            rows = []
            for name, data in zip(pdf["name"], pdf["content"], strict=True):
                m = tiff_metadata(data)
                rows.append({RASTER: name, **{k: m[k] for k in ("width", "height", "srid", "nodata", "dtype")}, **dict(zip("abcdef", m["transform"], strict=True))})
            yield pd.DataFrame(rows)

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    named = files.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("name"), "content")
    return named.mapInPandas(run, f"{RASTER} string, width int, height int, srid int, nodata double, dtype string, a double, b double, c double, d double, e double, f double")


# Tables of features ---------------------------------------------------------------------------------------------------


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRAINING).option("header", True).csv(path)


def read_all_training(spark: SparkSession, path: str, suffix: str = "_training_data.csv") -> DataFrame:
    """All training files below a path, with the watershed from each file's name."""
    df = spark.read.schema(TRAINING).option("header", True).option("pathGlobFilter", f"*{suffix}").csv(path)
    return df.withColumn("watershed", F.regexp_replace("_metadata.file_name", suffix.replace(".", "\\.") + "$", ""))


def write_training(df: DataFrame, path: str) -> None:
    df.select(*FEATURES, F.col("label").cast("int").alias("label")).write.mode("overwrite").option("header", True).csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Rows of one text column value, such as GeoJSON features or a report."""
    df.select("value").write.mode("overwrite").text(path)


# Parameters -----------------------------------------------------------------------------------------------------------

#: Parameters of training where nothing was tuned (fixed values).
DEFAULTS = {"n_estimators": 200.0, "max_depth": 8.0, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.6, "gamma": 0.5, "reg_alpha": 0.0, "reg_lambda": 2.0, "min_child_weight": 1.0}


def parsed_parameters(document: Column) -> Column:
    """A flat JSON object as a map."""
    return F.from_json(document, T.MapType(T.StringType(), T.DoubleType()))


def overlaid(default: Column, tuned: Column) -> Column:
    """default with what tuned has; a NULL map has nothing."""
    tuned = F.coalesce(tuned, F.create_map().cast("map<string,double>"))
    return F.map_concat(F.map_filter(default, lambda k, _: ~F.map_contains_key(tuned, k)), tuned)


def read_parameters(spark: SparkSession, path: str) -> dict[str, float]:
    """The tuned parameters over the defaults; without a file the defaults."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return dict(DEFAULTS)
    tuned = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    tuned.pop("best_cv_auc", None)
    return DEFAULTS | tuned


def parameter_document(params: Column, score: Column) -> Column:
    """JSON of the parameters without the class weight, and with the score to four decimals."""
    kept = F.map_filter(params, lambda k, _: k != "scale_pos_weight")
    return F.to_json(F.map_concat(kept, F.create_map(F.lit("best_cv_auc"), F.round(score, 4))))


# Listings -------------------------------------------------------------------------------------------------------------


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, stem and length of the files below a path, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "length").filter("trim(name) <> ''")


def unfinished(names: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The names of which there is no result yet."""
    return names.join(done, key, "left_anti")


def without_fixed(names: DataFrame, name: str = "name", ending: str = "_fixed.tif") -> DataFrame:
    return names.filter(~F.col(name).endswith(ending))


def only_raster(df: DataFrame) -> str:
    """The id of the one raster in df; an error that lists them if there are more, or none."""
    ids = [r[RASTER] for r in df.select(RASTER).distinct().orderBy(RASTER).limit(21).collect()]
    if len(ids) != 1:
        raise ValueError("expected one raster, found " + (", ".join(ids[:20]) or "none"))
    return ids[0]


def first_match(names: DataFrame, suffix: str, name: str = "name") -> str:
    """The first name that ends so; an error if there is none."""
    found = names.filter(F.col(name).endswith(suffix)).orderBy(name).limit(1).collect()
    if not found:
        raise FileNotFoundError(f"no file ends with {suffix}")
    return found[0][name]


# Reports --------------------------------------------------------------------------------------------------------------


def report_lines(title: str, values: dict[str, float | int | str]) -> list[str]:
    """A report: a title, then names and values in columns."""
    shown = lambda v: f"{v:,}" if isinstance(v, int) else f"{v:.4f}" if isinstance(v, float) else v
    return [title, "-" * len(title), *[f"{k:<35}{shown(v)}" for k, v in values.items()]]


def parse_report(lines: DataFrame) -> DataFrame:
    """(name, value) of the lines of a report."""
    return lines.select(F.trim(F.regexp_extract("value", r"^(.{35})(\S.*)$", 1)).alias("name"), F.regexp_extract("value", r"^(.{35})(\S.*)$", 2).alias("shown")).filter("name <> ''")


def append_run(spark: SparkSession, path: str, run: str, params: dict[str, float], metrics: dict[str, float], tags: dict[str, str]) -> None:
    """A row in the table of tracked runs."""
    spark.createDataFrame([(run, params, metrics, tags)], "run string, params map<string,double>, metrics map<string,double>, tags map<string,string>").withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)
