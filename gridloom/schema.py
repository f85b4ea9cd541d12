"""Names, types and constants of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns that place a cell.
RASTER, ROW, COL = "raster_id", "r", "c"
KEY = [RASTER, ROW, COL]
NODATA = -9999.0
#: Beyond it, positive or negative, a value is no measurement.
HUGE = 1e10
#: Below it a band's value makes a pixel invalid for models.
LEAST_VALID = -1e30

#: The bands of a stack, in order (fixed values).
FEATURES = (
    "slope elev_5x5_rel elev_5x5_std_dev slope_5x5_std_dev twi_10m twi_100m dd_s dd_h dd_v aspect curvature_profile curvature_plan "
    "tpi_3x3 tpi_11x11 tpi_21x21 tri elev_std_3x3 elev_std_9x9 slope_std_9x9 soil_clay_pct_0_5cm soil_clay_pct_5_15cm soil_clay_pct_15_30cm "
    "soil_ksat_0_5cm soil_ksat_5_15cm soil_ksat_15_30cm soil_organic_matter_0_5cm soil_organic_matter_5_15cm soil_organic_matter_15_30cm"
).split()

TRAINING = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES] + [T.StructField("label", T.IntegerType())])
TRANSFORM = T.StructType([T.StructField(x, T.DoubleType()) for x in "abcdef"])
METADATA = T.StructType(
    [
        T.StructField(RASTER, T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("srid", T.IntegerType()),
        T.StructField("transform", TRANSFORM),
        T.StructField("nodata", T.DoubleType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("bands", T.ArrayType(T.StringType())),
    ]
)
#: Prefixes of the wetland attributes that count (fixed values).
WETLAND_PREFIXES = ("PEM", "PSS", "PFO")
#: Box of the study region: west, south, east, north (fixed values).
REGION = (-124.6, 41.0, -120.5, 44.5)
