"""Sampling whole files, so that most of a large folder is never read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from decimal import Decimal
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.functions import exact_fraction
from pointlab.sources.points import conform


def name_hash(name: str, seed: int = 42) -> str:
    return hashlib.md5(f"{seed}:{name}".encode()).hexdigest()


def cut_off(names: Iterable[str], fraction: float | str | Decimal, seed: int = 42) -> str:
    """The highest hash among the ``max(1, floor(names * fraction))`` names whose seeded hash is lowest.

    The choice does not depend on listing order, and a smaller fraction picks a subset of a
    larger one.
    """
    hashes = sorted(name_hash(name, seed) for name in names)
    return hashes[max(1, int(len(hashes) * exact_fraction(fraction))) - 1]


def sample_files(spark: SparkSession, path: str, fraction: float | str | Decimal, seed: int = 42,
                 by: str = "file") -> DataFrame:
    """Points of a repeatable share of the Parquet files directly under ``path``.

    ``by="folder"`` takes whole folders below ``path`` instead, by their names: file names that Spark
    makes up differ from one writing to the next, folder names such as ``bucket=07`` do not.

    The driver handles names only, which Spark's own listing already holds. They become one cut-off
    of their hash in a filter on the file's metadata, so other files are not opened.
    """
    if by not in ("file", "folder"):
        raise ValueError(f"by must be file or folder, got {by}")
    try:
        raw = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no Parquet files under {path}") from error
        raise
    parts = [file.rsplit("/", 2)[-2:] for file in raw.inputFiles()]
    if by == "file":
        folder = path.rstrip("/").rsplit("/", 1)[-1]
        names = {name for parent, name in parts if unquote(parent) == folder}
        if not names:
            raise ValueError(f"no Parquet files directly under {path}")
        unit = F.col("_metadata.file_name")
    else:
        names = {parent for parent, _ in parts}
        unit = F.element_at(F.split("_metadata.file_path", "/"), -2)
    chosen = F.md5(F.concat(F.lit(f"{seed}:"), unit)) <= cut_off(names, fraction, seed)
    return conform(raw.where(chosen))
