from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import Row

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pointlab.operators.taskmetrics import read_event_log  # noqa: E402
from pointlab.schema import POINT_SCHEMA, SPLITS  # noqa: E402
from pointlab.session import session_builder  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
POINTS = T.StructType([*POINT_SCHEMA.fields, T.StructField("split", T.StringType())])


@pytest.fixture(scope="session")
def event_log_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("eventlog"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory, event_log_dir):
    session = (
        session_builder(
            "pointlab tests",
            event_log_dir=f"file://{event_log_dir}",
            extra={
                "spark.sql.shuffle.partitions": "8",
                "spark.driver.memory": "8g",
                "spark.ui.enabled": "false",
                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            },
        )
        .master("local[8]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def event_log(spark, event_log_dir):
    return lambda: read_event_log(spark, event_log_dir)


def point(code=2, split="train", z=1.0, x=0.0, y=0.0, intensity=10, red=100, green=50, blue=25, infrared=300, xyz=None):
    return Row(
        xyz=[float(x), float(y), float(z)] if xyz is None else xyz,
        Intensity=intensity,
        Classification=code,
        Red=red,
        Green=green,
        Blue=blue,
        Infrared=infrared,
        split=split,
    )


@pytest.fixture(scope="session")
def make_points(spark):
    def make(rows, splits=True):
        df = spark.createDataFrame([tuple(r) for r in rows], POINTS)
        return df if splits else df.drop("split")

    return make


@pytest.fixture(scope="session")
def point_folders(spark, make_points, tmp_path_factory):
    """20 files in each of three folders; file ``i`` of a split holds two points."""
    root = tmp_path_factory.mktemp("points")
    for s, split in enumerate(SPLITS):
        rows = [point(split=split, z=10 * s + i % 20, x=i, code=[2, 3, 6, 64][i % 4]) for i in range(40)]
        make_points(rows, splits=False).repartition(20).write.parquet(str(root / split))
    return root


def collect(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df):
    return df._jdf.queryExecution().toString()
