"""Parquet point tables: scan, column contract and split tagging."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlab.schema import FEATURE_SCHEMA, POINT_SCHEMA, SPLITS

# A folder or file name says its split by one of these as a whole word ("train_01", "TEST-1.parquet",
# "split=val", "validation"), never as a part of one ("values", "interval", "testament").
SPLIT_WORD = r"(?<![a-z])(train(?:ing)?|test(?:ing)?|val(?:id(?:ation)?)?|eval(?:uation)?)(?![a-z])"


def conform(df: DataFrame, schema: T.StructType = POINT_SCHEMA, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Project ``df`` to the contract: names matched without case, types cast.

    The check runs on the schema alone. Columns outside the contract are dropped unless listed
    in ``keep``, so the scan below never reads them.
    """
    have = {name.lower(): name for name in df.columns}
    missing = [field.name for field in schema if field.name.lower() not in have]
    if missing:
        raise ValueError(f"point table lacks the columns {missing}; it has {df.columns}")
    contract = [F.col(have[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*contract, *keep)


def _scan(spark: SparkSession, paths: Sequence[str], name_glob: str | None) -> DataFrame:
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(*paths)


def read_points(spark: SparkSession, *paths: str, name_glob: str | None = None) -> DataFrame:
    """One table from any number of Parquet files, folders or glob patterns."""
    if not paths:
        raise ValueError("no input paths")
    return conform(_scan(spark, paths, name_glob))


def _split_of_word(word: str) -> str:
    return next((split for split in ("train", "test") if word.startswith(split)), "val")


def split_of_path(path: str) -> str | None:
    """The split that a path names, anywhere in it; of several words the one nearest the file counts."""
    words = re.findall(SPLIT_WORD, path.lower())
    return _split_of_word(words[-1]) if words else None


def route_paths(paths: Iterable[str]) -> dict[str, list[str]]:
    """Sort input paths into splits by name."""
    routed: dict[str, list[str]] = {split: [] for split in SPLITS}
    for path in paths:
        split = split_of_path(path)
        if not split:
            raise ValueError(f"path names no split out of {SPLITS}: {path}")
        routed[split].append(path)
    return routed


def _split_of_file() -> Column:
    """``split_of_path`` of the file a row lies in."""
    path = F.col("_metadata.file_path")
    word = F.regexp_extract(F.lower(F.coalesce(F.try_url_decode(path), path)), f"^.*{SPLIT_WORD}", 1)
    return F.when(word.startswith("train"), "train").when(word.startswith("test"), "test").when(word != "", "val")


def tag_splits(spark: SparkSession, *paths: str, name_glob: str | None = None,
               schema: T.StructType = POINT_SCHEMA) -> DataFrame:
    """All paths as one table with ``split``.

    A table that has a ``split`` column, in any case, such as a partitioned one, keeps it. Else each
    file's path decides. Files are listed once, by Spark; every split is a filter on the file path,
    which leaves out other files before they are opened, with the split as a constant, so that a
    filter on it removes whole branches. A file that names no split is an error.
    """
    if not paths:
        raise ValueError("no input paths")
    raw = _scan(spark, paths, name_glob)
    own = next((name for name in raw.columns if name.lower() == "split"), None)
    if own:
        return conform(raw, schema, keep=[F.col(own).alias("split")])
    of_file = _split_of_file()
    # Only files without a split would be opened for this.
    stray = raw.where(of_file.isNull()).select("_metadata.file_path").head()
    if stray:
        raise ValueError(f"path names no split out of {SPLITS}: {stray[0]}")
    return union_splits({split: conform(raw.where(of_file == split), schema) for split in SPLITS})


def read_splits(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Exactly three paths, in the order train, val, test, as one table with ``split``.

    Each branch carries its split as a constant, so a filter on ``split`` removes whole branches.
    """
    if len(paths) != 3:
        raise ValueError(f"expected exactly 3 paths (train, val, test), got {len(paths)}")
    return union_splits({split: read_points(spark, path) for split, path in zip(SPLITS, paths)})


def union_splits(tables: dict[str, DataFrame]) -> DataFrame:
    """Stack one table per split, adding the split name as a column."""
    tagged = [table.withColumn("split", F.lit(split)) for split, table in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def read_features(spark: SparkSession, *paths: str) -> DataFrame:
    """A saved feature table, with ``split``."""
    return tag_splits(spark, *paths, schema=FEATURE_SCHEMA)


def in_split(split: str) -> Column:
    return F.col("split") == split
