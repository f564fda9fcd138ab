"""Tables in the shared folder of the session, and the columns the operators have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.session import scratch_path

# ASCII white space; a word is a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder, which outlives lost executors.
    It is removed when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def text_key(text: str = "text", seed: int = 0) -> Column:
    """One of two independent 64-bit hashes of a text; both together name the text."""
    return F.xxhash64(F.lit(seed), F.col(text))
