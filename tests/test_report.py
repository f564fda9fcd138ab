from __future__ import annotations

import pytest
from conftest import collect, plan_of, point

from pointlab.operators import report
from pointlab.operators.features import remap_classes
from pointlab.sources.points import in_split

# Class 6 only in train, class 9 only in test, code 7 (no class) everywhere.
ROWS = ([point(code=2)] * 5 + [point(code=6)] * 2 + [point(code=7)] * 3
        + [point(code=2, split="val")] * 3 + [point(code=7, split="val")]
        + [point(code=9, split="test"), point(code=7, split="test")])


@pytest.fixture
def classes(make_points):
    return remap_classes(make_points(ROWS))


def test_class_counts_by_any_case(make_points):
    df = make_points(ROWS)
    assert collect(report.class_counts(df, ["classification"]), "classification") == [(2, 8), (6, 2), (7, 5), (9, 1)]


def test_distribution_of_one_table_and_per_split(classes):
    train = report.class_distribution(classes.where(in_split("train")))
    assert collect(train, "Classification") == [(None, 30.0), (2, 50.0), (4, 20.0)]
    per_split = report.class_distribution(classes, by=["split"])
    assert collect(per_split.where("split = 'val'"), "Classification") == [("val", None, 25.0), ("val", 2, 75.0)]


def test_distribution_scans_once(spark, point_folders):
    df = report.class_distribution(spark.read.parquet(str(point_folders / "train")))
    physical = plan_of(df).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1
    assert "ReadSchema: struct<Classification:int>" in physical


def test_report_keeps_points_without_a_class_as_one_row(classes):
    rows = report.distribution_report(classes).collect()
    assert [tuple(r) for r in rows] == [
        (None, None, 30.0, 50.0, 25.0),
        (2, "Ground", 50.0, 0.0, 75.0),
        (4, "Building", 20.0, 0.0, 0.0),
        (5, "Water", 0.0, 50.0, 0.0),
    ]
    assert rows[0].__fields__ == ["Classification", "Description", "Train", "Test", "Val"]


def test_report_sums_to_a_hundred_and_rounds(make_points):
    df = remap_classes(make_points([point(code=c) for c in (1, 2, 6)]))
    rows = report.distribution_report(df).collect()
    assert [r.Train for r in rows] == [33.33] * 3
    assert [r.Test for r in rows] == [0.0] * 3


def test_outer_join_null_safe_and_plain(classes):
    tables = {s: report.class_distribution(classes.where(in_split(s))) for s in ("train", "val", "test")}
    safe = collect(report.outer_join_distributions(tables), "Classification")
    assert safe == [(None, 30.0, 25.0, 50.0), (2, 50.0, 75.0, 0.0), (4, 20.0, 0.0, 0.0), (5, 0.0, 0.0, 50.0)]
    plain = collect(report.outer_join_distributions(tables, null_safe=False), "Classification", "train", "val")
    assert plain[:3] == [(None, 0.0, 0.0, 50.0), (None, 0.0, 25.0, 0.0), (None, 30.0, 0.0, 0.0)]
    assert plain[3:] == safe[1:]


def test_describe_classes_with_another_legend(spark, classes):
    other = spark.createDataFrame([(2, "Soil")], "Classification int, Description string")
    got = report.describe_classes(classes, other).select("Classification", "Description").distinct()
    assert collect(got, "Classification") == [(None, None), (2, "Soil"), (4, None), (5, None)]
    assert "BroadcastHashJoin" in plan_of(report.describe_classes(classes))


def test_feature_summary(make_points):
    df = remap_classes(make_points([point(intensity=i) for i in (1, 2, 3)] + [point(code=6, intensity=None)]))
    got = collect(report.feature_summary(df, ["Intensity"]), "Classification")
    assert got == [(2, 3, "Intensity", 3, 2.0, 1.0, 1.0, 3.0), (4, 1, "Intensity", 0, None, None, None, None)]
