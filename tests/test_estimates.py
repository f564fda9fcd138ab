from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from conftest import collect, point
from pyspark.sql import functions as F

from pointlab.operators import folds, forest, halving, intervals, quantiles, sampling, weighted
from pointlab.operators.forest import with_class_label
from pointlab.operators.scoring import score
from pointlab.sources.estimates import class_estimate, files_by_size


@pytest.fixture(scope="module")
def many(make_points):
    rng = random.Random(6)
    rows = [point(code=rng.choice([2, 3, 6]), x=rng.uniform(0, 1000), y=rng.uniform(0, 1000), z=rng.uniform(0, 50), intensity=rng.choice([0, 1, 10, 100])) for _ in range(1500)]
    return make_points(rows + rows[:300] + [point(intensity=50, x=5.0)] * 1200 + [point(intensity=None, x=6.0)] * 20)


# Weighted samples


def keys_of(df):
    rows = df.withColumn("k", weighted.exponential_key(F.col("Intensity"))).where("k is not null").collect()
    return sorted((r.k, tuple(map(str, r[:-1]))) for r in rows)


@pytest.mark.parametrize("size", [0, 1, 17, 900, 1400, 10**6])
def test_weighted_sample_is_the_smallest_keys(many, monkeypatch, size):
    monkeypatch.setattr(weighted, "FEW", 40)
    monkeypatch.setattr(weighted, "BINS", 16)
    keys = keys_of(many)
    got = Counter(tuple(map(str, r)) for r in weighted.weighted_sample(many, size, "Intensity").collect())
    assert sum(got.values()) == min(size, len(keys))
    assert got == Counter(row for _, row in keys[:size])


def test_weighted_sample_counts_equal_points(make_points, monkeypatch):
    monkeypatch.setattr(weighted, "FEW", 5)
    same = make_points([point(intensity=50)] * 5000 + [point(intensity=1, x=i) for i in range(20)])
    for size in (3, 4999, 5010):
        assert weighted.weighted_sample(same, size, "Intensity").count() == size


def test_heavy_points_are_drawn_more_often(spark):
    df = spark.range(20_000).select(
        F.array(F.col("id").cast("double"), F.lit(0.0), F.lit(0.0)).alias("xyz"), F.when(F.col("id") % 2 == 0, 9).otherwise(1).alias("Intensity"),
        *[F.lit(1).alias(c) for c in ("Classification", "Red", "Green", "Blue", "Infrared")])
    drawn = Counter(r.Intensity for r in weighted.weighted_sample(df, 1000, "Intensity").collect())
    assert 850 < drawn[9] < 940
    small, large = ({tuple(r.xyz) for r in weighted.weighted_sample(df, n, "Intensity").collect()} for n in (100, 1000))
    assert small < large


# Quantiles


@pytest.mark.parametrize("bins", [2, 1024])
def test_exact_quantiles(spark, bins):
    rng = random.Random(8)
    rows = [(g, rng.choice([0.0, 1e300 * rng.random(), -1e-300 * rng.random(), rng.gauss(0, 1)]), rng.randrange(5), None if rng.random() < 0.5 else 1.5) for g in (1, 2, None) for _ in range(200)]
    rows += [(3, -1.7e308, 1, float("nan")), (3, 1.7e308, 1, None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "Classification int, a double, b int, c double")
    shares = (0.001, 0.25, 0.5, 0.99, 1.0)
    got = {(r.Classification, r.column_name, r.probability): r.value for r in quantiles.exact_quantiles(df, ["a", "b", "c"], shares, bins=bins).collect()}
    expected = {}
    for g in (1, 2, None, 3, 4):
        for i, c in enumerate("abc", 1):
            values = sorted(float(r[i]) for r in rows if r[0] == g and r[i] is not None and r[i] == r[i])
            for p in shares if values else ():
                expected[g, c, p] = values[max(1, math.ceil(round(p * len(values), 9))) - 1]
    assert got == expected
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df, ["a"], [0.0])


def test_sketches_merge_and_keep_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).cast("int").alias("Classification"), ((F.col("id") * 7919) % 60_000).cast("double").alias("v"))
    parts = [quantiles.quantile_sketches(df.where(F.pmod("v", F.lit(2)) == i), ["v"]) for i in range(2)]
    merged = quantiles.merge_sketches(parts[0].unionByName(parts[1]))
    for r in quantiles.sketched_quantiles(merged, (0.1, 0.5, 0.9)).collect():
        assert abs(r.value / 60_000 - r.probability) < 0.04
    assert merged.count() == 3


# Intervals


def test_poisson_weights_have_mean_and_variance_one(spark):
    number = intervals.replicate_number(F.col("id"), F.lit(3))
    drawn = Counter(r.w for r in spark.range(40_000).select(intervals.poisson_weight(number).alias("w")).collect())
    mean = sum(k * n for k, n in drawn.items()) / 40_000
    assert abs(mean - 1) < 0.03 and abs(sum((k - mean) ** 2 * n for k, n in drawn.items()) / 40_000 - 1) < 0.05
    assert abs(drawn[0] / 40_000 - math.exp(-1)) < 0.01


def test_intervals_have_the_width_of_a_binomial(spark):
    df = spark.range(4000).select("id", F.lit(1).alias("Classification"), F.when(F.col("id") % 10 < 7, 1).otherwise(2).alias("prediction"))
    got = {r.metric: r for r in intervals.metric_intervals(df, F.col("id"), 200).collect()}
    own = got["accuracy"]
    assert own.value == pytest.approx(0.7) == score(df).first().accuracy
    assert own.low < 0.7 < own.high and 0.7 < (own.high - own.low) / (2 * 1.96 * math.sqrt(0.7 * 0.3 / 4000)) < 1.3
    assert set(got) == set(intervals.METRICS)
    assert intervals.metric_intervals(df.where("false"), F.col("id"), 5).count() == 0
    again = {r.metric: r for r in intervals.metric_intervals(df.repartition(5), F.col("id"), 200).collect()}
    assert again == got


# Folds


def test_folds_keep_blocks_whole_and_classes_even(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-500, 500), rng.uniform(0, 1000), rng.choice([1, 1, 1, 2, 2, 3])) for i in range(6000)] + [(-1, 1.0, 1.0, None), (-2, None, 1.0, 1)]
    df = spark.createDataFrame(rows, "id long, x double, y double, Classification int")
    out = folds.with_fold(df, 4, 50.0)
    got = out.collect()
    assert len(got) == len(rows) and {r.fold for r in got if r.id < 0} == {None}
    blocks = {}
    for r in got:
        if r.id >= 0:
            blocks.setdefault((r.x // 50, r.y // 50), set()).add(r.fold)
    assert all(len(f) == 1 for f in blocks.values()) and set.union(*blocks.values()) == {0, 1, 2, 3}
    for c in (1, 2, 3):
        n = Counter(r.fold for r in got if r.Classification == c and r.id >= 0)
        assert max(n.values()) < 1.25 * min(n.values())
    with pytest.raises(ValueError):
        folds.block_folds(df, 1, 50.0)


def test_folds_serve_a_cross_validation(spark):
    rng = random.Random(5)
    rows = [(float(i % 20), float(i // 20), float(rng.random()), rng.choice([1, 2])) for i in range(400)]
    df = folds.with_fold(spark.createDataFrame(rows, "x double, y double, z double, Classification int"), 2, 5.0)
    model = forest.cross_validate(with_class_label(df), {"numTrees": [2]}, folds=2, fold_column="fold", columns=["x", "y", "z"])
    assert len(model.avgMetrics) == 1 and model.getFoldCol() == "fold"


# Halving


def test_halving_trains_fewer_rows_and_finds_the_best(spark):
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(1 << 60)).alias("sample_key"), *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000).alias(f"f{i}") for i in range(3)]
    ).withColumn("Classification", (F.floor(F.col("f0") * 4) + 4 * F.floor(F.col("f1") * 2) + 1).cast("double"))
    rows = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(df).repartition(2, "sample_key").cache()
    grid = [{"numTrees": 5, "maxDepth": d} for d in (1, 2, 3, 6)]
    found = halving.halving_search(rows, rows, grid)
    assert found.best["maxDepth"] == 6 and found.model.getOrDefault("maxDepth") == 6
    assert [len(r.accuracy) for r in found.rungs] == [4, 2, 1] and [float(r.fraction) for r in found.rungs] == [0.25, 0.5, 1.0]
    assert found.rungs[-1].rows == 4000 and found.rows_trained < len(grid) * 4000
    assert all(r.accuracy[r.kept[0]] == max(r.accuracy.values()) for r in found.rungs)
    rows.unpersist()
    with pytest.raises(ValueError):
        halving.halving_search(rows, rows, [])


# Files by size


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Files of very different sizes; large ones hold class 1 more often."""
    path = str(tmp_path_factory.mktemp("uneven"))
    total = Counter()
    for i in range(40):
        n = 200 * (i % 8 + 1) ** 2
        shift = 7 if i % 8 > 4 else 4
        df = spark.range(n).select(F.when(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10)) < shift, 1).otherwise(2).alias("Classification"), F.xxhash64("id", F.lit(i + 99)).alias("v"))
        df.coalesce(1).write.mode("append").parquet(path)
        total.update({r.Classification: r["count"] for r in df.groupBy("Classification").count().collect()})
    return path, total


def test_estimates_cover_the_truth(spark, uneven):
    path, total = uneven
    n = sum(total.values())
    inside = 0
    for seed in range(8):
        got = {r.Classification: r for r in class_estimate(spark, path, 12, seed=seed).collect()}
        assert sum(r.share for r in got.values()) == pytest.approx(1.0)
        assert all(r.files <= 12 for r in got.values())
        inside += sum(abs(got[c].share - total[c] / n) <= 2 * got[c].share_error for c in (1, 2))
        assert all(abs(got[c]["count"] / total[c] - 1) < 0.5 for c in (1, 2))
    assert inside >= 11


def test_files_are_drawn_by_their_bytes(spark, uneven):
    path, _ = uneven
    drawn = Counter()
    for seed in range(30):
        rows = files_by_size(spark, path, 10, seed).collect()
        assert sum(r.draws for r in rows) == 10
        drawn.update({r.path: r.draws for r in rows})
    sizes = {r.path: r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length").collect()}
    large = {p for p, s in sizes.items() if s > sorted(sizes.values())[20]}
    share = sum(sizes[p] for p in large) / sum(sizes.values())
    assert abs(sum(drawn[p] for p in large) / 300 - share) < 0.08
    with pytest.raises(ValueError):
        files_by_size(spark, path, 1)


def test_weights_of_digests_are_those_of_their_numbers(spark):
    edges = [f"{b + d:08x}" + rest for b in intervals.poisson_bounds() for d in (-1, 0, 1) for rest in ("", "0" * 24, "f" * 24)]
    df = spark.createDataFrame([(e,) for e in [*edges, "0" * 32, "f" * 32]], "digest string")
    number = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    got = df.select(intervals.weight_of_digest(F.col("digest")).alias("a"), intervals.poisson_weight(number).alias("b")).collect()
    assert all(r.a == r.b for r in got) and {r.a for r in got} == set(range(13))


def test_digests_are_drawn_from_the_texts_of_replicate_number(spark):
    df = spark.range(300).select(F.when(F.col("id") > 4, F.col("id")).alias("id"), (F.col("id") % 3).alias("Classification"), (F.col("id") % 2).alias("prediction"))
    got = intervals.bootstrap_confusion(df, F.col("id"), 6, hasher="md5")
    pairs = df.crossJoin(spark.range(7).select(F.col("id").cast("int").alias("replicate")))
    weight = F.when(F.col("replicate") == 0, 1).otherwise(intervals.poisson_weight(intervals.replicate_number(F.col("id"), F.col("replicate"), "md5")))
    wanted = pairs.groupBy("replicate", "Classification", "prediction").agg(F.sum(weight).alias("n")).where("n > 0")
    assert {tuple(map(int, r)) for r in got.collect()} == {tuple(map(int, r)) for r in wanted.collect()}
    assert "conv(" not in got._jdf.queryExecution().optimizedPlan().toString()


# Layout of equal rows


def test_equal_rows_are_dealt_out(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("v"), F.lit("s").alias("split"))
    out = sampling.fixed_layout(df, 8)
    sizes = Counter(r.p for r in out.select(F.spark_partition_id().alias("p")).collect())
    assert out.count() == 4000 and max(sizes.values()) < 600 and len(sizes) == 8
    assert Counter(collect(out)) == Counter(collect(df))
