from __future__ import annotations

import math

from conftest import collect, plan_of, point
from pyspark.sql import functions as F

from pointlab.operators import clean
from pointlab.operators.features import build_features, split_xyz


def test_impute_touches_feature_columns_only(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None, "t"), (1, 2.0, 3, None)], "Intensity int, NDVI double, Classification int, split string"
    )
    out = clean.impute_features(df, ["Intensity", "NDVI"])
    assert collect(out) == [(0, 0.0, None, "t"), (1, 2.0, 3, None)]


def test_drop_invalid_and_row_is_valid_agree(make_points):
    df = build_features(make_points([point(), point(red=0, infrared=0), point(xyz=[1.0]), point(xyz=[0.0, 0.0, math.nan]),
                                     point(code=None)]))
    assert clean.drop_invalid(df).count() == 2
    assert df.where(clean.row_is_valid(df)).count() == 2


def test_missing_report(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", float("nan"), None), ("b", 1.0, 2)], "split string, NDVI double, Red int")
    got = collect(clean.missing_report(df, ["NDVI", "Red"]), "split", "column_name")
    assert got == [("a", 2, "NDVI", 2), ("a", 2, "Red", 1), ("b", 1, "NDVI", 0), ("b", 1, "Red", 0)]


def test_duplicates_collapse_before_the_shuffle(make_points):
    df = make_points([point()] * 50 + [point(x=1)])
    out = clean.drop_duplicates(df)
    assert out.count() == 2
    assert clean.drop_duplicates(df, ["Classification"]).count() == 1
    physical = plan_of(out).split("== Physical Plan ==")[1]
    assert physical.index("Exchange") < physical.rindex("HashAggregate")


def test_drop_artifacts_keeps_points_without_a_code(make_points):
    df = make_points([point(code=c) for c in (2, 65, 66, 7, None)])
    assert [r[0] for r in collect(clean.drop_artifacts(df).select("Classification"), "Classification")] == [None, 2, 7]


def test_artifact_filter_reaches_the_scan(spark, point_folders):
    df = clean.drop_artifacts(spark.read.parquet(str(point_folders / "train")))
    assert "PushedFilters: [Or(IsNull(Classification),Not(In(Classification, [65,66])))]" in plan_of(df)


def test_outliers_by_split(make_points):
    rows = [point(z=i % 3) for i in range(30)] + [point(z=100)]
    rows += [point(z=100 + i % 3, split="val") for i in range(30)] + [point(xyz=[], split="val")]
    out = clean.drop_outliers(split_xyz(make_points(rows)), k=3)
    assert collect(out.groupBy("split").agg(F.count("*"), F.max("z")), "split") == [("train", 30, 2.0), ("val", 31, 102.0)]


def test_outliers_keep_everything_when_nothing_is_far(make_points):
    rows = [point(z=i % 3) for i in range(30)]
    assert clean.drop_outliers(split_xyz(make_points(rows, splits=False))).count() == 30
