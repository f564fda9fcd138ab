from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF_DIR, collect, point
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from pointlab.operators import forest
from pointlab.operators.clean import impute_features
from pointlab.operators.features import build_features
from pointlab.operators.transformers import feature_pipeline, label_indexer
from pointlab.plans import cross_validation_job, model_job, sampled_features_job, search_forest
from pointlab.schema import FEATURE_COLUMNS
from pointlab.sources.points import in_split


@pytest.fixture(scope="module")
def cloud(make_points):
    """Green tells the class; one point in nine has no class and one in fifty no vegetation index."""
    codes = [2, 3, 6, 9, 7, 2, 3, 6, 9]
    rows = []
    for i in range(1800):
        code = codes[i % 9]
        dark = i % 50 == 0
        rows.append(point(code=code, split=["train", "train", "train", "val", "test"][i % 5], x=i % 37, y=i % 41, z=i % 13,
                          green=code * 1000 + i % 7, red=0 if dark else 100 + i % 11, infrared=0 if dark else 300 + i % 5))
    return make_points(rows).cache()


@pytest.fixture(scope="module")
def table(cloud):
    assembled = feature_pipeline().fit(cloud).transform(cloud)
    return forest.with_class_label(assembled).select("split", "Classification", "features").repartition(4).cache()


def test_rows_without_a_class_are_not_trained_on(table):
    assert table.where("Classification is null").count() == 0
    assert table.schema["Classification"].metadata["ml_attr"]["num_vals"] == 9


def test_labels_are_class_codes_so_class_zero_is_empty(table):
    model = forest.forest(numTrees=2).fit(table.where(in_split("train")))
    assert model.numClasses == 9
    scored = forest.predictions(model, table.where(in_split("test")))
    assert scored.columns == ["Classification", "prediction", "probability"]
    assert {len(r.probability) for r in scored.collect()} == {9}


def test_forest_is_repeatable_at_fixed_partitions(table):
    train = table.where(in_split("train"))
    one, two = (forest.forest(numTrees=3).fit(train).toDebugString for _ in range(2))
    assert one.split("\n", 1)[1] == two.split("\n", 1)[1]


def test_holdout_search_scores_like_the_evaluator_and_keeps_the_best(spark, table):
    train, val = (table.where(in_split(s)) for s in ("train", "val"))
    search = forest.holdout_search(train, val, trees=(2, 4, 6), parallelism=2)
    for n, accuracy in search.accuracy.items():
        scored = forest.forest(numTrees=n).fit(train).transform(val)
        assert accuracy == pytest.approx(scored.agg(F.avg((F.col("prediction") == F.col("Classification")).cast("int"))).first()[0])
    assert search.accuracy[search.best_trees] == max(search.accuracy.values())
    assert search.model.getNumTrees == search.best_trees
    assert [r.is_best for r in search.table(spark).collect()].count(True) == 1


def test_ties_go_to_the_first(table):
    val = table.where(in_split("val")).limit(0)
    search = forest.holdout_search(table.where(in_split("train")), val, trees=(3, 2))
    assert search.accuracy == {3: 0.0, 2: 0.0}
    assert search.best_trees == 3


@pytest.mark.parametrize("how", ["persist", "table", "none"])
def test_training_table_gives_the_same_rows(spark, table, how):
    with forest.training_table(table.where(in_split("val")), how) as kept:
        assert kept.count() == table.where(in_split("val")).count()
        assert kept.schema["Classification"].metadata["ml_attr"]["num_vals"] == 9
    with pytest.raises(ValueError, match="persist"), forest.training_table(table, "elsewhere"):
        pass


def test_cross_validation_over_a_grid(cloud):
    train = forest.with_class_label(build_features(cloud.where(in_split("train"))))
    with pytest.raises(ValueError, match="at least 2 folds"):
        forest.cross_validate(train, folds=1)
    model = forest.cross_validate(train, {"numTrees": (2, 4), "maxDepth": (2, 4), "maxBins": (16,)}, folds=2)
    assert len(model.avgMetrics) == 4
    assert max(model.avgMetrics) > 0.6
    assert [type(s).__name__ for s in model.bestModel.stages] == ["VectorAssembler", "RandomForestClassificationModel"]


def test_cross_validated_forests_have_a_fixed_seed(cloud):
    train = forest.with_class_label(build_features(cloud.where(in_split("train"))))
    for params, seed in (({}, forest.SEED), ({"seed": 7}, 7)):
        model = forest.cross_validate(train, {"numTrees": (1,)}, folds=2, **params)
        assert model.bestModel.stages[-1].getOrDefault("seed") == seed


def test_class_count_follows_the_mapping(make_points):
    df = make_points([point(code=c, z=i, green=c * 100) for i in range(20) for c in (2, 40)])
    mapping = {2: 3, 40: 12}
    stages = feature_pipeline(mapping=mapping).fit(df)
    rows = forest.with_class_label(stages.transform(df), mapping=mapping).select("Classification", "features")
    model = forest.forest(numTrees=2).fit(rows)
    assert model.numClasses == 13
    assert {r.prediction for r in model.transform(rows).collect()} == {3.0, 12.0}


def test_a_training_table_is_removed(spark, table):
    with forest.training_table(table.where(in_split("val")), "table") as kept:
        folder = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_labels_by_frequency(make_points):
    df = make_points([point(code=c) for c in (3, 3, 3, 10, 10, 2, 2, None)]).select("Classification")
    out = label_indexer().fit(df).transform(df).distinct()
    assert collect(out, "label") == [(3, 0.0), (10, 1.0), (2, 2.0)]


def test_search_forest_end_to_end(cloud):
    run = search_forest(cloud, trees=(3, 5), partitions=4)
    assert run.test_metrics.accuracy > 0.6
    assert run.test_metrics.n_scored == feature_pipeline().fit(cloud).transform(cloud).where(
        "split = 'test' and Classification is not null").count()
    indexed = search_forest(cloud, trees=(3,), partitions=4, index_labels=True, train_floor=True, keep_training="none")
    assert indexed.search.model.numClasses == 4
    assert indexed.test_metrics.accuracy > 0.6


def test_saved_models_predict_alike(cloud, tmp_path):
    run = search_forest(cloud, trees=(3,), partitions=4)
    run.stages.write().overwrite().save(str(tmp_path / "stages"))
    run.search.model.write().overwrite().save(str(tmp_path / "forest"))
    stages = PipelineModel.load(str(tmp_path / "stages"))
    model = RandomForestClassificationModel.load(str(tmp_path / "forest"))

    def predicted(first, second):
        return sorted(tuple(r) for r in second.transform(first.transform(cloud)).select("x", "y", "z", "split", "prediction").collect())

    assert predicted(stages, model) == predicted(run.stages, run.search.model)


def test_model_pipeline_on_features(cloud):
    features = build_features(cloud)
    model = forest.model_pipeline(numTrees=3, maxDepth=4).fit(features.where(in_split("train")))
    assert model.stages[1].labels == ["2", "3", "4", "5"]
    assert model.transform(features.where(in_split("test"))).select("prediction").distinct().count() > 1
    assert forest.model_pipeline().getStages()[2].getMaxDepth() == 15


def test_model_job_imputes_or_skips(cloud):
    features = build_features(cloud)
    for impute in (False, True):
        model, predicted = model_job(features, numTrees=3, impute=impute)
        assert predicted.count() == features.where("split = 'test' and NDVI is not null").count()
        assert model.stages[1].getNumTrees == 3


def test_model_job_fails_on_invalid_rows_if_asked(cloud):
    features = build_features(cloud)
    with pytest.raises(Exception, match="(?i)null"):
        model_job(features, numTrees=2, invalid="error")[1].collect()
    model, predicted = model_job(impute_features(features), numTrees=2, invalid="error")
    assert predicted.count() == features.where("split = 'test'").count()


def test_cross_validation_job(cloud):
    model, metrics = cross_validation_job(cloud, "0.5", {"numTrees": (2, 3)}, folds=2, partitions=4)
    assert len(model.avgMetrics) == 2
    assert 0.5 < metrics.accuracy <= 1


def test_sampled_features_keep_the_floor_of_all_points(cloud):
    model, predicted = sampled_features_job(cloud, "0.3", partitions=4, numTrees=3)
    assert 0 < predicted.count() < cloud.where(in_split("test")).count()
    assert model.stages[0].getInputCols() == FEATURE_COLUMNS


SEARCH = """
import sys
sys.path.insert(0, {root!r})
from pointlab.session import session_builder
from point_queries.views import points_view
from pointlab.plans import search_forest
spark = session_builder("x", extra={{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}}).master("local[{cores}]").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
run = search_forest(points_view(spark, {tables!r}), partitions=8, trees=(5, 10))
print("RESULT", run.search.accuracy, run.search.best_trees, tuple(run.test_metrics))
"""


def test_the_search_does_not_depend_on_cores():
    root = str(Path(__file__).resolve().parent.parent)
    found = set()
    for cores in (2, 3, 4):
        code = SEARCH.format(root=root, cores=cores, tables=SF_DIR)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
        found.add(next(line for line in out.splitlines() if line.startswith("RESULT")))
    assert len(found) == 1
