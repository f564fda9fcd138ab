"""Queries on samples, quantiles, folds and intervals, beside those of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from pointlab.functions import key_bound
from pointlab.operators import features, folds, forest, halving, intervals, quantiles, report, sampling, transformers, weighted
from pointlab.schema import FEATURE_COLUMNS, SPLITS
from pointlab.sources.estimates import class_estimate
from pointlab.sources.points import in_split
from point_queries.catalog import _FEATURES, _KEY, _KNOWN, _POINTS, _REMAPPED, _USABLE, PARTITIONS, _features, _plausible, _register, _remapped, _with
from point_queries.views import points_view, staged_points

SAMPLE = 2500
PROBABILITIES = (0.05, 0.5, 0.95)
REPLICATES, CONFIDENCE = 40, 0.9
FOLDS, FOLD_SIDE = 4, 2500.0
HALVING_GRID = [{"numTrees": 4, "maxDepth": 3}, {"numTrees": 4, "maxDepth": 6}, {"numTrees": 8, "maxDepth": 3}, {"numTrees": 8, "maxDepth": 6}]
DRAWS = 24


# Weighted sample

_columns = "point_id, xyz, Intensity, Classification, Red, Green, Blue, Infrared, split"


@_register(_with(_POINTS, f"keyed as (select *, -ln((cast({_KEY} as double) + 0.5) / 1152921504606846976.0) / Intensity as sample_key from points where Intensity > 0)",
                 f"ranked as (select *, row_number() over (order by sample_key, {', '.join(f'{c} nulls first' for c in _columns.split(', '))}) as r from keyed)")
           + f"select point_id, xyz[1] as x, xyz[3] as z, Intensity, Classification, split from ranked where r <= {SAMPLE}")
def weighted_sample(spark, sf_dir):
    """A fixed number of points, drawn by intensity without replacement."""
    drawn = weighted.weighted_sample(points_view(spark, sf_dir), SAMPLE, "Intensity", hasher="md5")
    return features.split_xyz(drawn).select("point_id", "x", "z", "Intensity", "Classification", "split")


# Quantiles

_long = " union all ".join(f"select Classification, '{c}' as column_name, cast({c} as double) as v from features where {c} is not null" for c in FEATURE_COLUMNS)
_probabilities = ", ".join(f"({p}::decimal(20,12))" for p in PROBABILITIES)


@_register(_with(_POINTS, _REMAPPED, _FEATURES, f"long as ({_long})",
                 "ranked as (select *, row_number() over (partition by Classification, column_name order by v) as r, count(*) over (partition by Classification, column_name) as n from long)")
           + f"select Classification, column_name, cast(p as double) as probability, v as value from ranked, (values {_probabilities}) t(p) where r = greatest(1, cast(ceil(p * n) as bigint))")
def feature_quantiles(spark, sf_dir):
    """Exact quantiles of every feature per class."""
    return quantiles.exact_quantiles(_features(spark, sf_dir), FEATURE_COLUMNS, PROBABILITIES)


# Intervals

_bounds = intervals.poisson_bounds()
_weight = " + ".join(f"(u >= {b})::int" for b in _bounds)
_metrics = ", ".join(f"('{m}')" for m in intervals.METRICS)
_low, _high = (f"greatest(1, cast(ceil({REPLICATES} * {share!r}::double) as int))" for share in ((1 - CONFIDENCE) / 2, 1 - (1 - CONFIDENCE) / 2))


@_register(_with(_POINTS, _REMAPPED, f"""drawn as (select Classification as label, cast(floor(Green / 4096) as int) % 8 + 1 as prediction, replicate,
    cast('0x' || substr(md5(point_id || '|' || replicate), 1, 8) as bigint) as u
  from remapped, (select unnest(range(0, {REPLICATES} + 1)) as replicate) where Classification is not null)""",
    f"confusion as (select replicate, label, prediction, sum(case when replicate = 0 then 1 else {_weight} end)::double as n from drawn group by all having sum(case when replicate = 0 then 1 else {_weight} end) > 0)",
    """sized as (select *, sum(n) over (partition by replicate, label) as support, sum(n) over (partition by replicate, prediction) as predicted from confusion)""",
    "hits as (select *, n / predicted as p, n / support as r from sized where label = prediction)",
    "totals as (select replicate, sum(n) as total from confusion group by replicate)",
    """metrics as (select replicate, sum(n) / total as accuracy, sum(2*p*r/(p+r) * support) / total as f1, sum(p * support) / total as weighted_precision,
    sum(r * support) / total as weighted_recall from totals join hits using (replicate) group by replicate, total)""",
    "long as (" + " union all ".join(f"select replicate, '{m}' as metric, {m} as value from metrics" for m in intervals.METRICS) + ")",
    f"sorted as (select metric, list_sort(list(value) filter (replicate > 0)) as drawn, max(value) filter (replicate = 0) as value from long group by metric)")
           + f"select metric, round(value, 9) as value, round(drawn[{_low}], 9) as low, round(drawn[{_high}], 9) as high from sorted")
def metric_intervals(spark, sf_dir):
    """Bootstrap intervals of the metrics of a fixed rule."""
    rule = _remapped(spark, sf_dir).withColumn("prediction", F.floor(F.col("Green") / 4096) % 8 + 1)
    found = intervals.metric_intervals(rule, F.col("point_id"), REPLICATES, CONFIDENCE, hasher="md5")
    return found.select("metric", *[F.round(c, 9).alias(c) for c in ("value", "low", "high")])


# Folds

_FOLDS = f"""per_class as (select floor(x / {FOLD_SIDE})::bigint as block_x, floor(y / {FOLD_SIDE})::bigint as block_y, Classification as label, count(*) as n
  from remapped where Classification is not null group by all),
blocks as (select block_x, block_y, sum(n) as n, first(label order by n desc, label) as top_class from per_class group by all),
starts as (select top_class, sum(count(*)) over (order by top_class) - count(*) as start from blocks group by top_class),
placed as (select block_x, block_y, (row_number() over (partition by top_class order by n desc, block_x, block_y) - 1 + start) % {2 * FOLDS} as turn from blocks join starts using (top_class)),
dealt as (select block_x, block_y, cast(case when turn < {FOLDS} then turn else {2 * FOLDS - 1} - turn end as int) as fold from placed)"""


@_register(_with(_POINTS, _REMAPPED, _FOLDS) + "select fold, label as Classification, cast(sum(n) as bigint) as n, count(*) as n_blocks from dealt join per_class using (block_x, block_y) group by fold, label")
def block_folds(spark, sf_dir):
    """Points and blocks per fold and class, with folds made of whole blocks of space."""
    points = features.split_xyz(_remapped(spark, sf_dir)).drop("xyz")
    dealt = folds.with_fold(points, FOLDS, FOLD_SIDE).where("fold is not null")
    block = F.struct(*folds.block_of(FOLD_SIDE))
    return dealt.groupBy("fold", "Classification").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(block).alias("n_blocks"))


# Search by halving

_rungs = ", ".join(f"({i}, {len(HALVING_GRID) >> i}, {key_bound(f)})" for i, f in enumerate(("0.25", "0.5", "1")))


@_register(_with(_POINTS, _REMAPPED, _FEATURES, "keyed as (select point_id, " + _KEY + " as key, split, Classification, xyz from points)",
                 f"train as (select key from (select {_KEY} as key, case when Infrared + Red <> 0 then 1 end as lit, xyz[3] as z, Classification from points where split = 'train') where lit is not null and z is not null and Classification is not null and Classification <> 7)")
           + f"select cast(rung as int) as rung, cast(n_candidates as int) as n_candidates, (select count(*) from train where key < bound) as n_trained, true as plausible, true as best_goes_on from (values {_rungs}) t(rung, n_candidates, bound)")
def halving_search(spark, sf_dir):
    """Four forests on a quarter of the training rows, two on half of them, the best one on all."""
    points = points_view(spark, sf_dir)
    train = sampling.fixed_layout(points.where(in_split("train")), PARTITIONS).withColumn("sample_key", sampling.key_of_point("md5"))
    stages = transformers.feature_pipeline().fit(train)
    tables = [forest.with_class_label(stages.transform(t)) for t in (train, points.where(in_split("val")))]
    with forest.training_table(tables[0].select("Classification", "features", "sample_key")) as kept:
        found = halving.halving_search(kept, tables[1].select("Classification", "features"), HALVING_GRID)
    rows = [
        (i, len(r.accuracy), r.rows, all(map(_plausible, r.accuracy.values())), r.accuracy[r.kept[0]] == max(r.accuracy.values()))
        for i, r in enumerate(found.rungs)
    ]
    return spark.createDataFrame(rows, "rung int, n_candidates int, n_trained long, plausible boolean, best_goes_on boolean")


# Estimates from files


@_register(_with(_POINTS, _KNOWN) + "select Classification, count(*) as n, true as share_covered, true as count_covered from known group by Classification")
def file_estimate(spark, sf_dir):
    """Whether class shares and counts estimated from files drawn by size hold the true ones within five standard errors."""
    path = staged_points(spark, sf_dir)
    known = points_view(spark, sf_dir).where(F.col("split").isin(*SPLITS))
    true = report.class_counts(known, ["Classification"]).withColumn("true_share", F.col("n") / F.sum("n").over(_all_rows()))
    found = class_estimate(spark, path, DRAWS).withColumnRenamed("Classification", "of")
    within = lambda value, truth, error: F.coalesce(F.abs(F.col(value) - F.col(truth)) <= 5 * F.col(error) + 1e-9, F.lit(False))
    joined = true.join(found, F.col("Classification").eqNullSafe(F.col("of")), "left")
    return joined.select("Classification", "n", within("share", "true_share", "share_error").alias("share_covered"), within("count", "n", "count_error").alias("count_covered"))


def _all_rows():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))
