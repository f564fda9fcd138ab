from __future__ import annotations

import pytest
from conftest import collect, plan_of, point
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pointlab.schema import CLASS_NAMES, POINT_COLUMNS, SPLITS
from pointlab.sources import (
    conform,
    cut_off,
    legend,
    read_features,
    read_points,
    read_splits,
    route_paths,
    sample_files,
    tag_splits,
    write_points,
)
from pointlab.sources.files import name_hash
from pointlab.sources.points import in_split, split_of_path


def test_conform_matches_names_without_case_and_casts(spark):
    df = spark.sql(
        "select array(1f, 2f, 3f) XYZ, 1S intensity, 2L classification, 3 red, 4 green, 5 blue, 6 infrared, 'x' other"
    )
    out = conform(df)
    assert out.columns == POINT_COLUMNS
    assert dict(out.dtypes) == {"xyz": "array<double>", **dict.fromkeys(POINT_COLUMNS[1:], "int")}
    assert out.first().xyz == [1.0, 2.0, 3.0]


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="Infrared"):
        conform(spark.sql("select array(1d) xyz, 1 Intensity, 2 Classification, 3 Red, 4 Green, 5 Blue"))


def test_read_many_paths_and_globs(spark, point_folders):
    assert read_points(spark, *[str(point_folders / s) for s in SPLITS]).count() == 120
    assert read_points(spark, f"{point_folders}/t*/*.parquet").count() == 80
    assert read_points(spark, str(point_folders / "val"), name_glob="part-0000*").count() < 40
    with pytest.raises(ValueError, match="no input"):
        read_points(spark)


@pytest.mark.parametrize(
    ("path", "split"),
    [("s3a://b/data/train/part-0.parquet", "train"), ("s3a://b/data/TEST-001.parquet", "test"),
     ("/d/split=val/part-0.parquet", "val"), ("/d/eval/a.parquet", "val"), ("/d/validation/a.parquet", "val"),
     ("/d/interval/a.parquet", None), ("/d/contest/a.parquet", None), ("/train/x/y.parquet", "train"),
     ("/d/train/2020", "train"), ("s3://b/train/tile_01/", "train"), ("/test-bucket/val/2020/07/x.parquet", "val"),
     ("/d/values/x.parquet", None), ("/d/testament/x.parquet", None), ("/d/train/TEST_1.parquet", "test"),
     ("/d/training_set/a.parquet", "train"), ("/d/validation01/a.parquet", "val"), ("a.parquet", None)],
)
def test_split_of_path(path, split):
    assert split_of_path(path) == split


def test_route_paths():
    routed = route_paths(["s3a://b/data/train/", "/x/TEST*.parquet", "/x/val", "/y/test"])
    assert routed == {"train": ["s3a://b/data/train/"], "val": ["/x/val"], "test": ["/x/TEST*.parquet", "/y/test"]}
    with pytest.raises(ValueError, match="interval"):
        route_paths(["/data/interval/a"])


EXPECTED = [("test", 40), ("train", 40), ("val", 40)]


def test_tag_splits_by_given_paths(spark, point_folders):
    df = tag_splits(spark, *[str(point_folders / s) for s in SPLITS])
    assert collect(df.groupBy("split").count(), "split") == EXPECTED
    one = df.where(in_split("val"))
    assert plan_of(one).split("== Physical Plan ==")[1].count("FileScan") == 1


def test_tag_splits_by_file_paths_opens_only_wanted_files(spark, point_folders):
    df = tag_splits(spark, f"{point_folders}/*/*.parquet")
    assert collect(df.groupBy("split").count(), "split") == EXPECTED
    one = df.where(in_split("val"))
    assert plan_of(one).split("== Physical Plan ==")[1].count("FileScan") == 1
    assert 0 < one.rdd.getNumPartitions() < df.rdd.getNumPartitions()
    assert one.count() == 40


def test_tag_splits_uses_a_partition_column(spark, make_points, tmp_path):
    write_points(make_points([point(split=s) for s in SPLITS]), str(tmp_path / "table"))
    df = tag_splits(spark, str(tmp_path / "table"))
    assert collect(df.groupBy("split").count(), "split") == [(s, 1) for s in sorted(SPLITS)]
    assert "PartitionFilters: [isnotnull(split" in plan_of(df.where(in_split("val")))


def test_files_without_a_split_are_an_error(spark, make_points, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("plain")
    make_points([point()], splits=False).write.parquet(str(tmp_path / "all/interval"))
    make_points([point()], splits=False).write.parquet(str(tmp_path / "all/train"))
    with pytest.raises(ValueError, match="interval"):
        tag_splits(spark, str(tmp_path / "all/*"))


def test_nested_folders_keep_their_split(spark, make_points, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("nested")
    for i, place in enumerate(("train/2020/tile 1", "train/2021", "val/2020", "Test%20set/x")):
        make_points([point()] * (i + 1), splits=False).write.parquet(str(tmp_path / "d" / place))
    paths = [str(tmp_path / "d" / p) for p in ("train/2020", "train/2021", "val", "Test%20set/x")]
    df = tag_splits(spark, str(tmp_path / "d/*/*/*.parquet"), str(tmp_path / "d/train/2020/tile 1"))
    assert collect(df.groupBy("split").count(), "split") == [("test", 4), ("train", 3), ("val", 3)]
    assert collect(tag_splits(spark, *paths[1:2]).groupBy("split").count()) == [("train", 2)]
    one = plan_of(tag_splits(spark, paths[1])).split("== Physical Plan ==")[1]
    assert "(1 paths)" in one and "(2 paths)" not in one


def test_a_split_column_is_matched_without_case(spark, make_points, tmp_path):
    make_points([point(split="val")] * 3).withColumnRenamed("split", "Split").write.parquet(str(tmp_path / "train"))
    assert collect(tag_splits(spark, str(tmp_path / "train")).groupBy("split").count()) == [("val", 3)]


def test_read_splits_takes_exactly_three_paths(spark, point_folders):
    df = read_splits(spark, [str(point_folders / s) for s in SPLITS])
    assert collect(df.groupBy("split").count(), "split") == EXPECTED
    with pytest.raises(ValueError, match="exactly 3"):
        read_splits(spark, ["a", "b"])


def chosen(files, fraction, seed=42):
    return {f for f in files if name_hash(f, seed) <= cut_off(files, fraction, seed)}


def test_cut_off_counts():
    files = [f"f{i}.parquet" for i in range(100)]
    assert [len(chosen(files, f)) for f in (0.29, 0.001, 1)] == [29, 1, 100]
    many = [f"f{i}" for i in range(8_000)]
    assert [len(chosen(many, f)) for f in (0.01, 0.03)] == [80, 240]


def test_cut_off_is_repeatable_and_nested():
    files = [f"f{i}.parquet" for i in range(100)]
    assert cut_off(files, 0.3) == cut_off(files[::-1], 0.3)
    assert chosen(files, 0.1) < chosen(files, 0.3)
    assert chosen(files, 0.3) != chosen(files, 0.3, seed=7)


def test_sample_folders(spark, make_points, tmp_path):
    rows = make_points([point(x=i) for i in range(40)], splits=False)
    for copy in "ab":
        write_points(rows.withColumn("bucket", F.col("xyz")[0].cast("int") % 8), str(tmp_path / copy), partition_by=["bucket"])
    one, two = (sample_files(spark, str(tmp_path / copy), 0.25, by="folder") for copy in "ab")
    assert one.count() == 10 and collect(one.select("xyz"), "xyz") == collect(two.select("xyz"), "xyz")
    with pytest.raises(ValueError, match="folder"):
        sample_files(spark, str(tmp_path / "a"), 0.25, by="size")


def test_sample_files_reads_only_chosen_files(spark, point_folders):
    path = str(point_folders / "train")
    sample = sample_files(spark, path, 0.25)
    assert sample.columns == POINT_COLUMNS
    scanned = spark.read.parquet(path)
    names = {r[0] for r in sample.select("xyz").join(
        scanned.select("xyz", F.col("_metadata.file_name").alias("f")), "xyz").select("f").collect()}
    assert len(names) <= 5
    assert sample.rdd.getNumPartitions() <= 5 < scanned.select("xyz").rdd.getNumPartitions() + 1
    assert collect(sample) == collect(sample_files(spark, path + "/", 0.25))
    assert sample_files(spark, path, 1).count() == 40


def test_sample_files_with_special_characters_in_names(spark, make_points, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("special")
    folder = tmp_path / "tiles of 50%"
    folder.mkdir()
    make_points([point(x=i) for i in range(8)], splits=False).repartition(4).write.parquet(str(tmp_path / "plain"))
    for i, file in enumerate(sorted((tmp_path / "plain").glob("*.parquet"))):
        file.rename(folder / f"tile {i} \u00e9 %20.parquet")
    assert sample_files(spark, str(folder), 1).count() == 8
    with pytest.raises(ValueError, match="names no split"):
        tag_splits(spark, f"{tmp_path}/tiles*/*")
    assert 0 < sample_files(spark, str(folder), "0.5").count() < 8


def test_sample_files_without_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no Parquet"):
        sample_files(spark, str(tmp_path / "empty"), 0.5)
    with pytest.raises(AnalysisException):
        sample_files(spark, str(tmp_path / "absent"), 0.5)


def test_sample_files_takes_no_files_from_subfolders(spark, point_folders):
    with pytest.raises(ValueError, match="directly under"):
        sample_files(spark, str(point_folders) + "/*", 0.5)


def test_write_points_overwrites(spark, make_points, tmp_path):
    path = str(tmp_path / "out")
    write_points(make_points([point(), point(split="val")]), path)
    write_points(make_points([point(split="test")] * 5), path, max_records_per_file=2)
    back = spark.read.parquet(path)
    assert collect(back.select("split")) == [("test",)] * 5
    assert len(back.inputFiles()) >= 3


def test_read_features(spark, make_points, tmp_path):
    from pointlab.operators.features import build_features

    features = build_features(make_points([point(z=2), point(z=5), point(z=9, split="val")]))
    write_points(features, str(tmp_path / "features"))
    back = read_features(spark, str(tmp_path / "features"))
    assert back.columns == features.columns
    assert collect(back.select("split", "z_norm"), "split", "z_norm") == [("train", 0.0), ("train", 3.0), ("val", 0.0)]


def test_legend_needs_no_job(spark):
    table = legend(spark)
    assert collect(table) == list(CLASS_NAMES.items())
    assert "LocalTableScan" in plan_of(table)
    assert all(name == name.strip() for name in CLASS_NAMES.values())
