"""Column contract, class codes and feature order of the point table."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per laser point, as it lies in the source files.
POINT_SCHEMA = T.StructType(
    [
        T.StructField("xyz", T.ArrayType(T.DoubleType())),
        T.StructField("Intensity", T.IntegerType()),
        T.StructField("Classification", T.IntegerType()),
        T.StructField("Red", T.IntegerType()),
        T.StructField("Green", T.IntegerType()),
        T.StructField("Blue", T.IntegerType()),
        T.StructField("Infrared", T.IntegerType()),
    ]
)
POINT_COLUMNS = POINT_SCHEMA.names

SPLITS = ("train", "val", "test")

# Raw class code -> land-cover class. Any other code has no class.
CLASS_MAPPING = {
    1: 1,
    2: 2,
    3: 3,
    4: 3,
    5: 3,
    6: 4,
    9: 5,
    17: 6,
    64: 7,
    65: 8,
    66: 8,
}

# Land-cover class -> description.
CLASS_NAMES = {
    1: "Unclassified",
    2: "Ground",
    3: "Vegetation",
    4: "Building",
    5: "Water",
    6: "Bridge",
    7: "Permanent structures",
    8: "Filtered/Artifacts",
}


ARTIFACT_CLASS = 8
ARTIFACT_CODES = [code for code, cls in CLASS_MAPPING.items() if cls == ARTIFACT_CLASS]

# Model input order, and the columns of a saved feature table.
FEATURE_COLUMNS = ["x", "y", "z_norm", "Intensity", "Red", "Green", "Blue", "Infrared", "NDVI"]
FINAL_COLUMNS = [
    "x", "y", "z_norm", "Intensity", "Classification", "Red", "Green", "Blue", "Infrared", "NDVI",
]

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in ("x", "y", "z_norm", "NDVI") else T.IntegerType())
        for name in FINAL_COLUMNS
    ]
)
