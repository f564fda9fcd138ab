"""The class legend as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointlab.schema import CLASS_NAMES


def legend(spark: SparkSession) -> DataFrame:
    """Eight rows, class and description, planned as a local relation that needs no job."""
    rows = ", ".join(f"({code}, '{name}')" for code, name in CLASS_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(Classification, Description)")
