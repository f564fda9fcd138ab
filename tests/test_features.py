from __future__ import annotations

import re

from conftest import collect, plan_of, point
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from pointlab.operators.features import build_features, normalise_height, split_xyz, table_statistics
from pointlab.operators.transformers import (
    ClassDistribution,
    ClassRemapper,
    FixedHeightModel,
    FixedHeightNormalizer,
    HeightNormalizer,
    assembler,
    feature_columns,
    feature_pipeline,
)
from pointlab.schema import FEATURE_COLUMNS, FINAL_COLUMNS

ROWS = [point(z=5), point(z=7), point(z=-2, split="val"), point(z=1, split="val"), point(z=9, split="test"),
        point(z=3, split=None), point(z=4, split="other"), point(xyz=[1.0], split="test")]


def heights(df):
    return collect(df.select("split", "z_norm"), "split", F.col("z_norm").asc_nulls_first())


def test_height_within_each_split(make_points):
    got = heights(normalise_height(split_xyz(make_points(ROWS))))
    assert got == [(None, 0.0), ("other", 0.0), ("test", None), ("test", 0.0),
                   ("train", 0.0), ("train", 2.0), ("val", 0.0), ("val", 3.0)]


def test_height_within_the_table_or_above_a_floor(make_points):
    df = split_xyz(make_points(ROWS))
    assert [h for _, h in heights(normalise_height(df, by_split=False))] == [5.0, 6.0, None, 11.0, 7.0, 9.0, 0.0, 3.0]
    assert heights(normalise_height(df, floor=1.0))[-1] == ("val", 0.0)
    plain = normalise_height(split_xyz(make_points(ROWS, splits=False)))
    assert plain.agg(F.min("z_norm")).first()[0] == 0.0


def test_filtering_features_does_not_change_the_offset(make_points):
    df = build_features(make_points(ROWS))
    assert heights(df.where("z_norm > 0")) == [("train", 2.0), ("val", 3.0)]


def test_build_features_columns_and_types(make_points):
    df = build_features(make_points([point(), point(red=0, infrared=0)]))
    assert df.columns == [*FINAL_COLUMNS, "split"]
    assert dict(df.dtypes)["Classification"] == "int"
    assert [r.NDVI for r in df.collect()] == [0.5, None]


def test_height_plan_has_one_subquery_and_no_join(make_points):
    df = build_features(make_points(ROWS))
    df.collect()
    final = plan_of(df).split("== Physical Plan ==")[1].split("Initial Plan")[0]
    assert "Join" not in final
    executed = set(re.findall(r"(?<!Reused)Subquery subquery#(\d+)", final))
    assert len(executed) == 1


def test_table_statistics_of_an_empty_table(make_points):
    df = split_xyz(make_points([]))
    stats = table_statistics(df, True, top=F.max("z"))
    assert df.withColumn("top", stats["top"]).collect() == []


def test_pipeline_fit_runs_no_job(spark, make_points):
    tracker = spark.sparkContext.statusTracker()
    df = make_points(ROWS)
    before = len(tracker.getJobIdsForGroup(None))
    model = feature_pipeline().fit(df)
    model.transform(df)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_pipeline_gives_nine_inputs_in_order_and_skips_invalid(make_points):
    rows = feature_pipeline().fit(make_points(ROWS)).transform(make_points(ROWS)).collect()
    assert len(rows) == 7
    row = next(r for r in rows if r.split == "train" and r.z == 7)
    assert list(row.features) == [0.0, 0.0, 2.0, 10.0, 100.0, 50.0, 25.0, 300.0, 0.5]


def test_assembler_can_fail_on_invalid(make_points):
    import pytest

    df = build_features(make_points([point(red=0, infrared=0)]))
    assert assembler(invalid="skip").transform(df).count() == 0
    with pytest.raises(Exception, match="(?i)null"):
        assembler(invalid="error").transform(df).collect()


def test_saved_pipeline_transforms_alike(make_points, tmp_path):
    df = make_points(ROWS)
    for stages in (feature_pipeline(), Pipeline(stages=[HeightNormalizer(scope="table")])):
        model = stages.fit(df)
        path = str(tmp_path / f"{stages.uid}")
        model.write().overwrite().save(path)
        loaded = PipelineModel.load(path)
        assert sorted(map(str, loaded.transform(df).collect())) == sorted(map(str, model.transform(df).collect()))


def test_train_floor_is_learnt_once_and_saved(make_points, tmp_path):
    df = make_points(ROWS)
    model = FixedHeightNormalizer().fit(df.where("split = 'train'"))
    assert heights(model.transform(df))[-2:] == [("val", -7.0), ("val", -4.0)]
    model.write().overwrite().save(str(tmp_path / "m"))
    assert FixedHeightModel.load(str(tmp_path / "m")).getOrDefault("floor") == 5.0
    whole = feature_pipeline(train_floor=True, assemble=False).fit(df.where("split = 'train'"))
    whole.write().overwrite().save(str(tmp_path / "p"))
    assert heights(PipelineModel.load(str(tmp_path / "p")).transform(df)) == heights(model.transform(df))


def test_distribution_stage(make_points):
    df = make_points([point(code=2)] * 3 + [point(code=3)])
    assert collect(ClassDistribution().transform(df), "Classification") == [(2, 75.0), (3, 25.0)]


def test_feature_columns_by_exclusion(make_points):
    for splits in (True, False):
        assert feature_columns(build_features(make_points(ROWS, splits=splits))) == FEATURE_COLUMNS


def test_every_split_has_its_own_floor(make_points):
    df = make_points([point(z=z, split=s) for z, s in ((0, "extra"), (5, "extra"), (1000, "holdout"), (1007, "holdout"), (50, None), (51, None), (3, ""))])
    assert heights(normalise_height(split_xyz(df))) == [
        (None, 0.0), (None, 1.0), ("", 0.0), ("extra", 0.0), ("extra", 5.0), ("holdout", 0.0), ("holdout", 7.0)]


def test_remapper_saves_its_mapping(make_points, tmp_path):
    df = make_points([point(code=2), point(code=40), point(code=3)])
    stage = ClassRemapper.of({2: 11, 40: 12})
    stage.write().overwrite().save(str(tmp_path / "remapper"))
    loaded = ClassRemapper.load(str(tmp_path / "remapper"))
    assert [r.Classification for r in loaded.transform(df).collect()] == [11, 12, None]
    assert [r.Classification for r in ClassRemapper().transform(df).collect()] == [2, None, 3]
