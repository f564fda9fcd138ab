from __future__ import annotations

import pytest
from conftest import collect, plan_of

from pointlab.plans import distribution_job, feature_job, forest_job, preview_features, raw_distribution_job
from pointlab.schema import FINAL_COLUMNS, SPLITS
from pointlab.session import OBJECT_STORE, remove, scratch_path, session_builder
from pointlab.sources import read_features


@pytest.fixture(scope="module")
def paths(point_folders):
    return [str(point_folders / s) for s in SPLITS]


def test_distribution_jobs(spark, paths):
    rows = collect(distribution_job(spark, *paths))
    assert rows == [(c, d, 25.0, 25.0, 25.0) for c, d in ((2, "Ground"), (3, "Vegetation"), (4, "Building"), (7, "Permanent structures"))]
    assert raw_distribution_job(spark, *paths).count() == 12


def test_distribution_job_reads_one_column_once(spark, paths):
    physical = plan_of(distribution_job(spark, *paths)).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 3
    assert physical.count("ReadSchema: struct<Classification:int>") == 3


def test_feature_job_and_preview(spark, paths, tmp_path):
    feature_job(spark, paths, str(tmp_path / "features"))
    back = read_features(spark, str(tmp_path / "features"))
    assert back.columns == [*FINAL_COLUMNS, "split"]
    assert back.count() == 120
    assert {r.split: r["min(z_norm)"] for r in back.groupBy("split").min("z_norm").collect()} == {s: 0.0 for s in SPLITS}
    previews = preview_features(spark, *paths)
    assert {s: p.count() for s, p in previews.items()} == {s: 5 for s in SPLITS}


def test_height_minimum_reads_only_coordinates(spark, paths):
    from pointlab.operators.features import build_features
    from pointlab.sources import tag_splits

    physical = plan_of(build_features(tag_splits(spark, *paths))).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<xyz:array<double>>" in physical


def test_forest_job(spark, paths):
    run = forest_job(spark, paths, "0.5", trees=(2,))
    assert run.search.best_trees == 2
    assert 0 <= run.test_metrics.accuracy <= 1
    with pytest.raises(ValueError, match="exactly 3"):
        forest_job(spark, paths[:2])


def test_scratch_path_is_in_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(root)
    assert first != second


def test_what_is_written_to_scratch_can_be_removed(spark, tmp_path):
    path = scratch_path(spark, "a")
    spark.range(3).write.parquet(path)
    remove(spark, path)
    assert spark.range(3).write.parquet(path) is None  # the folder is gone, so this is no overwrite


def test_session_builder_settings():
    options = session_builder("x", cores=32, object_store=True, event_log_dir="/logs")._options
    assert options["spark.sql.shuffle.partitions"] == "128"
    assert options["spark.eventLog.dir"] == "/logs"
    assert OBJECT_STORE.items() <= options.items()
