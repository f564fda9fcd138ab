"""Every operator as a query over the given tables, with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.functions import key_bound
from pointlab.operators import clean, features, forest, report, sampling, scoring, taskmetrics, transformers
from pointlab.plans.jobs import cross_validation_job, find_forest, sampled_features_job, search_forest
from pointlab.schema import CLASS_MAPPING, CLASS_NAMES, FEATURE_COLUMNS, SPLITS
from pointlab.session import scratch_path
from pointlab.sources import legend, read_points, read_splits, sample_files, tag_splits, write_points
from pointlab.sources.points import in_split, union_splits
from point_queries.views import CODES_BY_PART, lineitem, points_view, staged_buckets, staged_points

Query = Callable[[SparkSession, str], DataFrame]



# ---------------------------------------------------------------- SQL building blocks

_codes = " ".join(f"when {i} then {code}" for i, code in enumerate(CODES_BY_PART) if code)
_POINTS = f"""points as (
  select l_orderkey*10 + l_linenumber as point_id,
    list_value(l_extendedprice, cast(l_orderkey as double),
      case when l_linenumber <> 7 then l_quantity*10.0 + l_discount*100.0 end) as xyz,
    cast(l_partkey*37 % 3000 as int) as Intensity,
    cast(case l_partkey % 13 {_codes} end as int) as Classification,
    cast(case when l_partkey % 50 = 0 then 0 else (l_suppkey+1)*500 % 65536 end as int) as Red,
    cast((l_partkey % 13)*4096 + l_quantity*16 as int) as Green,
    cast(l_linenumber*8000 as int) as Blue,
    cast(case when l_partkey % 50 = 0 then 0 else l_quantity*1024 end as int) as Infrared,
    case when l_orderkey % 10 < 6 then 'train' when l_orderkey % 10 = 6 then 'extra'
      when l_orderkey % 10 = 8 then 'val' when l_orderkey % 10 = 9 then 'test' end as split
  from lineitem)"""
_KNOWN = "known as (select * from points where split in ('train', 'val', 'test'))"

_classes = " ".join(f"when {code} then {cls}" for code, cls in CLASS_MAPPING.items())
_REMAPPED = f"""remapped as (
  select point_id, xyz, xyz[1] as x, xyz[2] as y, xyz[3] as z, Intensity,
    cast(case Classification {_classes} end as int) as Classification,
    Red, Green, Blue, Infrared, split
  from points)"""

_FEATURES = """features as (
  select point_id, x, y, z - min(z) over (partition by split) as z_norm, Intensity, Classification,
    Red, Green, Blue, Infrared,
    case when Infrared + Red <> 0
      then (cast(Infrared as double) - Red) / (cast(Infrared as double) + Red) end as NDVI,
    split
  from remapped)"""

_names = ", ".join(f"({cls}, '{name}')" for cls, name in CLASS_NAMES.items())
_LEGEND = f"legend as (select * from (values {_names}) as t(Classification, Description))"

_key_parts = [f"coalesce(cast(cast(floor(xyz[{axis}]*1000 + 0.5) as bigint) as varchar), '')" for axis in (1, 2, 3)]
_key_parts += [
    f"coalesce(cast({c} as varchar), '')"
    for c in ("Intensity", "Classification", "Red", "Green", "Blue", "Infrared")
]
_KEY = f"cast('0x' || substr(md5(concat_ws('|', {', '.join(_key_parts)})), 1, 15) as bigint)"

_VALID = "NDVI is not null and z_norm is not null"
_FINAL = "x, y, z_norm, Intensity, Classification, Red, Green, Blue, Infrared, NDVI"


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- queries

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def _register(sql: str | None = None, name: str | None = None):
    def add(query: Query) -> Query:
        _queries[name or query.__name__] = query
        if sql is not None:
            _oracles[name or query.__name__] = sql
        return query

    return add


def _remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.remap_classes(points_view(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(points_view(spark, sf_dir), keep=("point_id",))


# Sources and sinks


@_register(_with(_POINTS, _KNOWN) + """select split, xyz[1] as x, xyz[2] as y, xyz[3] as z, Intensity, Classification,
  Red, Green, Blue, Infrared from known""")
def scan_points(spark, sf_dir):
    """Many Parquet paths as one contract-checked table, each row tagged from its file's path."""
    root = staged_points(spark, sf_dir)
    return features.split_xyz(tag_splits(spark, *[f"{root}/split={s}" for s in SPLITS])).drop("xyz")


@_register(_with(_POINTS, _KNOWN) + "select split, count(*) as n from known group by split")
def split_counts(spark, sf_dir):
    """Rows per split, the split read from the path of each file."""
    files = f"{staged_points(spark, sf_dir)}/*/*.parquet"
    return report.class_counts(tag_splits(spark, files), ["split"])


@_register(_with(_POINTS, _KNOWN, _REMAPPED.replace("from points", "from known")) + """select Classification,
    count(*) filter (where split = 'train') as train, count(*) filter (where split = 'test') as test,
    count(*) filter (where split = 'val') as val from remapped group by Classification""")
def distribution_nested(spark, sf_dir):
    """Classes per split of files that lie in folders below those of the splits."""
    root = staged_buckets(spark, sf_dir)
    points = features.remap_classes(tag_splits(spark, *[f"{root}/{s}/bucket=*/" for s in SPLITS]))
    return points.groupBy("Classification").agg(*[F.count_if(in_split(s)).alias(s) for s in ("train", "test", "val")])


@_register(_with(_POINTS, _KNOWN) + "select split, Classification, count(*) as n from known group by split, Classification")
def split_by_position(spark, sf_dir):
    """Exactly three paths in the order train, val, test."""
    root = staged_points(spark, sf_dir)
    return report.class_counts(read_splits(spark, [f"{root}/split={s}" for s in SPLITS]), ["split", "Classification"])


@_register(_with(_POINTS) + "select Classification, count(*) as n from points where split = 'test' group by Classification")
def glob_scan(spark, sf_dir):
    """Files picked by a path pattern."""
    return report.class_counts(read_points(spark, f"{staged_points(spark, sf_dir)}/split=te*/*.parquet"))


@_register(_with(_POINTS, _KNOWN, """buckets as (select split, bucket,
    row_number() over (partition by split order by md5('42:bucket=' || bucket)) as place,
    greatest(1, count(*) over (partition by split) * 25 // 100) as wanted
  from (select distinct split, point_id % 16 as bucket from known))""") + """select k.split, Classification, count(*) as n
  from known k join buckets b on k.split = b.split and k.point_id % 16 = b.bucket and place <= wanted
  group by k.split, Classification""")
def file_sample(spark, sf_dir):
    """Rows per split and class in a quarter of the folders of each split."""
    root = staged_buckets(spark, sf_dir)
    sampled = union_splits({s: sample_files(spark, f"{root}/{s}", "0.25", by="folder") for s in SPLITS})
    return report.class_counts(sampled, ["split", "Classification"])


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + f"select point_id, split, {_FINAL} from features")
def save_reload(spark, sf_dir):
    """The feature table written one folder per split, and read back."""
    path = scratch_path(spark, "features")
    write_points(_features(spark, sf_dir), path)
    return spark.read.parquet(path)


@_register(_with(_LEGEND) + "select cast(Classification as int) as Classification, Description, count(point_class) as n_points "
           "from legend left join (select * from (" + _with(_POINTS, _REMAPPED)
           + "select Classification as point_class from remapped)) on Classification = point_class "
           "group by Classification, Description")
def class_legend(spark, sf_dir):
    """The literal legend, with the points of each of its classes."""
    counts = report.class_counts(_remapped(spark, sf_dir))
    return legend(spark).join(counts, "Classification", "left").select(
        "Classification", "Description", F.coalesce("n", F.lit(0)).alias("n_points")
    )


# Projections and scalar functions


@_register(_with(_POINTS) + "select point_id, Intensity, split, xyz[1] as x, xyz[2] as y, xyz[3] as z, "
           "xyz[4] as beyond from points")
def xyz_split(spark, sf_dir):
    """Coordinates out of the array; an index past its end is NULL."""
    points = features.split_xyz(points_view(spark, sf_dir))
    return points.select("point_id", "Intensity", "split", "x", "y", "z", F.get("xyz", F.lit(3)).alias("beyond"))


@_register(_with(_POINTS, _REMAPPED) + "select point_id, Intensity, Classification from remapped")
def remap_classes(spark, sf_dir):
    """Raw codes to land-cover classes."""
    return _remapped(spark, sf_dir).select("point_id", "Intensity", "Classification")


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + "select point_id, Red, Infrared, NDVI from features")
def ndvi(spark, sf_dir):
    """Vegetation index."""
    return features.add_ndvi(points_view(spark, sf_dir)).select("point_id", "Red", "Infrared", "NDVI")


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + f"select point_id, split, {_FINAL} from features", name="features")
def feature_table(spark, sf_dir):
    """All ten final columns, height normalised within each split."""
    return _features(spark, sf_dir)


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + f"""select point_id, split,
  {', '.join(f'coalesce({c}, 0) as {c}' for c in FEATURE_COLUMNS)}, Classification from features""")
def impute_features(spark, sf_dir):
    """Zero for missing feature values."""
    return clean.impute_features(_features(spark, sf_dir))


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + f"""select split, Classification, count(*) as n_rows,
  count(*) filter (where {_VALID}) as n_valid,
  count(*) filter (where {_VALID} and Classification is not null) as n_trainable
  from features group by split, Classification""")
def valid_rows(spark, sf_dir):
    """Rows with all features, and with a class too, per split and class."""
    table = _features(spark, sf_dir)
    valid = clean.row_is_valid(table)
    return table.groupBy("split", "Classification").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(valid & F.col("Classification").isNotNull()).alias("n_trainable"),
    )


@_register(_with(_POINTS, _REMAPPED, _FEATURES)
           + f"select point_id, split, {_FINAL} from features where {_VALID}")
def drop_invalid(spark, sf_dir):
    """Only rows with all features."""
    return clean.drop_invalid(_features(spark, sf_dir))


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + f"""select split, count(*) as n_rows, count(*) filter (where not ({_VALID})) as n_invalid
  from features group by split""")
def invalid_rows(spark, sf_dir):
    """Rows per split on which assembling fails if it is not told to skip them."""
    table = _features(spark, sf_dir)
    invalid = ~clean.row_is_valid(table, transformers.feature_columns(table, ("Classification", "split", "point_id")))
    return table.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(invalid).alias("n_invalid"))


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + " union all ".join(
    f"select cast({i} as int) as place, '{c}' as column_name, count({c}) as n_values from features"
    for i, c in enumerate(FEATURE_COLUMNS)))
def feature_list(spark, sf_dir):
    """Model inputs as all columns but the class, the split and the key, with the values each has."""
    table = _features(spark, sf_dir)
    names = transformers.feature_columns(table, ("Classification", "split", "point_id"))
    counts = table.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "n_values")
    place = F.array_position(F.array(*map(F.lit, names)), F.col("column_name")) - 1
    return counts.select(place.cast("int").alias("place"), "column_name", "n_values")


# Aggregates and reports


@_register(_with(_POINTS) + "select Classification, count(*) as n from points group by Classification")
def raw_class_counts(spark, sf_dir):
    """Rows per raw code."""
    return report.class_counts(points_view(spark, sf_dir))


_SHARES = """select split, Classification{n}, count(*) / sum(count(*)) over (partition by split) * 100 as percentage
  from {table} group by split, Classification"""


@_register(_with(_POINTS, _REMAPPED) + _SHARES.format(table="remapped", n=""))
def class_distribution(spark, sf_dir):
    """Class shares per split."""
    return report.class_distribution(_remapped(spark, sf_dir), by=["split"])


@_register(_with(_POINTS) + _SHARES.format(table="points", n=", count(*) as n"))
def raw_distribution(spark, sf_dir):
    """Raw code counts and shares per split."""
    return report.class_distribution(points_view(spark, sf_dir), by=["split"], counts=True)


@_register(_with(_POINTS, _REMAPPED, _LEGEND) + """select r.Classification, Description,
    round(count(*) filter (where split = 'train') / (select count(*) from points where split = 'train') * 100, 2) as Train,
    round(count(*) filter (where split = 'test') / (select count(*) from points where split = 'test') * 100, 2) as Test,
    round(count(*) filter (where split = 'val') / (select count(*) from points where split = 'val') * 100, 2) as Val
  from remapped r left join legend l on r.Classification = l.Classification
  group by r.Classification, Description order by r.Classification""")
def distribution_report(spark, sf_dir):
    """Class shares of the three splits side by side, with descriptions."""
    return report.distribution_report(_remapped(spark, sf_dir))


def _one_split(split: str) -> str:
    return f"""{split} as (select Classification, count(*) / sum(count(*)) over () * 100 as percentage
  from remapped where split = '{split}' group by Classification)"""


@_register(_with(_POINTS, _REMAPPED, *[_one_split(s) for s in SPLITS]) + """select
    coalesce(train.Classification, val.Classification, test.Classification) as Classification,
    coalesce(train.percentage, 0) as train, coalesce(val.percentage, 0) as val, coalesce(test.percentage, 0) as test
  from train full join val on train.Classification is not distinct from val.Classification
  full join test on coalesce(train.Classification, val.Classification) is not distinct from test.Classification""")
def distribution_outer_join(spark, sf_dir):
    """Three distributions joined, rows without a class to each other."""
    points = _remapped(spark, sf_dir)
    return report.outer_join_distributions({s: report.class_distribution(points.where(in_split(s))) for s in SPLITS})


@_register(_with(_POINTS, _REMAPPED, *[_one_split(s) for s in SPLITS]) + """select Classification,
    coalesce(train.percentage, 0) as train, coalesce(val.percentage, 0) as val, coalesce(test.percentage, 0) as test
  from train full join val using (Classification) full join test using (Classification)""")
def distribution_outer_join_using(spark, sf_dir):
    """Three distributions joined by plain equality, under which rows without a class never meet."""
    points = _remapped(spark, sf_dir)
    tables = {s: report.class_distribution(points.where(in_split(s))) for s in SPLITS}
    return report.outer_join_distributions(tables, null_safe=False)


@_register(_with(_POINTS, _REMAPPED, _LEGEND) + """select point_id, Intensity, r.Classification, Description
  from remapped r left join legend l on r.Classification = l.Classification""")
def label_points(spark, sf_dir):
    """Each point with the description of its class."""
    return report.describe_classes(_remapped(spark, sf_dir)).select(
        "point_id", "Intensity", "Classification", "Description"
    )


def _summary_sql(column: str) -> str:
    return f"""select Classification, count(*) as n_rows, '{column}' as column_name, count({column}) as n,
    round(avg({column}), 3) as mean, round(stddev_samp({column}), 3) as sd,
    round(cast(min({column}) as double), 3) as min, round(cast(max({column}) as double), 3) as max
  from features group by Classification"""


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + " union all ".join(_summary_sql(c) for c in FEATURE_COLUMNS))
def feature_summary(spark, sf_dir):
    """Count, mean, deviation and range of every feature per class."""
    return report.feature_summary(_features(spark, sf_dir), FEATURE_COLUMNS)


# Order, limit, samples, partitioning


@_register(_with(_POINTS, _REMAPPED, _FEATURES)
           + f"select point_id, split, {_FINAL} from features order by point_id, Intensity, x, Red limit 5")
def preview_topk(spark, sf_dir):
    """The first five feature rows in key order."""
    return _features(spark, sf_dir).orderBy("point_id", "Intensity", "x", "Red").limit(5)


@_register(_with(_POINTS) + f"""select point_id, Intensity, Classification, split from points
  where {_KEY} < {key_bound('0.01')}""")
def hash_sample(spark, sf_dir):
    """One percent of the rows by key."""
    return sampling.hash_sample(points_view(spark, sf_dir), "0.01", "md5").select(
        "point_id", "Intensity", "Classification", "split"
    )


@_register(_with(_POINTS, _REMAPPED) + f"""select point_id, Intensity, Classification, split from remapped
  where {_KEY} < case Classification when 1 then {key_bound('0.5')} when 3 then {key_bound('0.1')}
    when 4 then {key_bound('0.25')} when 8 then {key_bound('0.05')} end""")
def stratified_hash_sample(spark, sf_dir):
    """A fraction per class by key, classes not named left out."""
    fractions = {1: "0.5", 3: "0.1", 4: "0.25", 8: "0.05"}
    return sampling.stratified_hash_sample(_remapped(spark, sf_dir), fractions, "md5").select(
        "point_id", "Intensity", "Classification", "split"
    )


@_register(_with(_POINTS, _REMAPPED, f"keyed as (select *, {_KEY} as key from remapped where Classification is not null)",
                 """ranked as (select *, count(*) over (partition by Classification) as size,
    row_number() over (partition by Classification
      order by key, point_id, xyz, Intensity, Red, Green, Blue, Infrared, split) as place from keyed)""")
           + """select point_id, Intensity, Classification, split, x, y, z from ranked where place <= ceil(size * 0.1)""")
def stratified_sample(spark, sf_dir):
    """Exactly a tenth of each class, rounded up."""
    sampled = sampling.stratified_sample(_remapped(spark, sf_dir), "0.1", hasher="md5")
    return features.split_xyz(sampled).select("point_id", "Intensity", "Classification", "split", "x", "y", "z")


@_register(_with(_POINTS, f"keyed as (select *, {_KEY} as key from points where Classification is not null)",
                 """ranked as (select *, count(*) over (partition by Classification) as size,
    row_number() over (partition by Classification
      order by key, point_id, xyz, Intensity, Red, Green, Blue, Infrared, split) as place from keyed)""")
           + "select point_id, Intensity, Classification, split from ranked where place <= ceil(size * 0.1)")
def stratified_sample_raw(spark, sf_dir):
    """Exactly a tenth of each raw code, rounded up."""
    sampled = sampling.stratified_sample(points_view(spark, sf_dir), "0.1", hasher="md5")
    return sampled.select("point_id", "Intensity", "Classification", "split")


def _rung_sql(fraction: str) -> str:
    return (f"select Classification, cast({fraction} as double) as fraction, "
            f"count(*) filter (where key < {key_bound(fraction)}) as n from keyed group by Classification")


@_register(_with(_POINTS, _REMAPPED, f"keyed as (select Classification, {_KEY} as key from remapped)")
           + " union all ".join(_rung_sql(f) for f in sampling.LADDER))
def fraction_ladder(spark, sf_dir):
    """Rows per class for each of six nested fractions."""
    return sampling.fraction_ladder(_remapped(spark, sf_dir), hasher="md5")


@_register(_with(_POINTS) + """select split, Classification, count(*) as n, cast(sum(Intensity) as bigint) as intensity
  from points group by split, Classification""")
def repartition_invariant(spark, sf_dir):
    """An aggregate after redistributing the rows."""
    spread = sampling.spread_rows(points_view(spark, sf_dir), sampling.spread_for(executors=4, cores=2))
    return spread.groupBy("split", "Classification").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Intensity").alias("intensity")
    )


# Cleaning

_checked = [*FEATURE_COLUMNS, "Classification"]


@_register(_with(_POINTS, _REMAPPED, _FEATURES) + " union all ".join(
    f"select split, count(*) as n_rows, '{c}' as column_name, count(*) - count({c}) as n_missing from features group by split"
    for c in _checked))
def missing_report(spark, sf_dir):
    """Missing values per split and column."""
    return clean.missing_report(_features(spark, sf_dir), _checked)


@_register(_with(_POINTS) + "select distinct split, Classification, Red, Blue from points")
def dedup_points(spark, sf_dir):
    """Distinct rows of a narrow table."""
    return clean.drop_duplicates(points_view(spark, sf_dir).select("split", "Classification", "Red", "Blue"))


@_register(_with(_POINTS, "kept as (select *, xyz[3] as z from points where Classification is null or Classification not in (65, 66))",
                 "stats as (select split, avg(z) as mean, stddev_samp(z) as sd from kept group by split)")
           + """select point_id, Intensity, Classification, kept.split as split, z from kept join stats on kept.split is not distinct from stats.split
  where coalesce(abs(z - mean) <= 1.5 * sd, true)""")
def outlier_filter(spark, sf_dir):
    """Artifacts dropped by raw code, then heights far from their split's mean."""
    points = features.split_xyz(clean.drop_artifacts(points_view(spark, sf_dir)))
    return clean.drop_outliers(points, k=1.5).select("point_id", "Intensity", "Classification", "split", "z")


# Learning


@_register(_with(_POINTS, _REMAPPED, """labels as (select Classification,
    row_number() over (order by count(*) desc, cast(Classification as varchar)) - 1 as label
  from remapped where split = 'train' and Classification is not null group by Classification)""")
           + """select Classification, cast(label as int) as label, count(*) as n
  from remapped join labels using (Classification) group by Classification, label""")
def label_index(spark, sf_dir):
    """Label index of each class, learnt on train and applied to all splits."""
    points = _remapped(spark, sf_dir).select("split", "Classification")
    indexed = transformers.label_indexer().fit(points.where(in_split("train"))).transform(points)
    return report.class_counts(indexed.withColumn("label", F.col("label").cast("int")), ["Classification", "label"])


_RULE_SQL = _with(_POINTS, _REMAPPED, """scored as (select split, Classification as label,
    cast(floor(Green / 4096) as int) % 8 + 1 as prediction from remapped where Classification is not null)""",
    "confusion as (select split, label, prediction, count(*) as n from scored group by all)",
    """sized as (select *, sum(n) over (partition by split, label) as support,
    sum(n) over (partition by split, prediction) as predicted from confusion)""",
    "hits as (select *, n / predicted as p, n / support as r from sized where label = prediction)",
    "totals as (select split, sum(n) as total from confusion group by split)") + """select totals.split as split,
  cast(total as bigint) as n_scored, round(coalesce(sum(n), 0) / total, 9) as accuracy,
  round(coalesce(sum(2*p*r/(p+r) * support), 0) / total, 9) as f1,
  round(coalesce(sum(p * support), 0) / total, 9) as weighted_precision,
  round(coalesce(sum(r * support), 0) / total, 9) as weighted_recall
  from totals left join hits on totals.split is not distinct from hits.split group by totals.split, total"""


@_register(_RULE_SQL)
def metrics_rule(spark, sf_dir):
    """Accuracy, F1, precision and recall of a fixed rule."""
    rule = F.floor(F.col("Green") / 4096) % 8 + 1
    scored = scoring.score(_remapped(spark, sf_dir).withColumn("prediction", rule), by=["split"])
    names = ["accuracy", "f1", "weighted_precision", "weighted_recall"]
    return scored.select("split", "n_scored", *[F.round(n, 9).alias(n) for n in names])


# Where training rows lie is part of the result, so it is fixed here.
PARTITIONS = 8
# Accuracy that any forest reaches on these points.
FLOOR = 0.5
_SEARCHED = ", ".join(f"({n})" for n in forest.SEARCH_TREES)
_GRID = ", ".join(f"({n})" for n in forest.GRID_TREES)
_USABLE = f"usable as (select * from features where {_VALID} and Classification is not null)"


def _plausible(accuracy: float) -> bool:
    return bool(FLOOR <= accuracy <= 1)


def _assembled(points: DataFrame) -> DataFrame:
    stages = transformers.feature_pipeline().fit(points)
    return forest.with_class_label(stages.transform(points)).select("split", "Classification", "features")


def _small_forest(spark: SparkSession, sf_dir: str):
    points = sampling.fixed_layout(points_view(spark, sf_dir).where(in_split("train")), PARTITIONS)
    with forest.training_table(_assembled(points).drop("split")) as train:
        return forest.forest(numTrees=10).fit(train)


@_register(_with(_POINTS, _REMAPPED, _FEATURES, _USABLE) + """select split, count(*) as n_scored, true as known_classes,
  true as plausible from usable group by split""")
def rf_predict_counts(spark, sf_dir):
    """Rows a fitted forest scores per split, whether it predicts known classes only, and how well."""
    scored = _small_forest(spark, sf_dir).transform(_assembled(points_view(spark, sf_dir)))
    hit = F.avg((F.col("prediction") == F.col("Classification")).cast("double"))
    return scored.groupBy("split").agg(
        F.count("prediction").alias("n_scored"),
        F.every(F.col("prediction").between(min(CLASS_NAMES), max(CLASS_NAMES))).alias("known_classes"),
        hit.between(FLOOR, 1).alias("plausible"),
    )


@_register(_with(_POINTS, _REMAPPED, _FEATURES, _USABLE) + "select split, count(*) as n_scored, "
           "cast(0 as bigint) as n_different from usable group by split")
def model_round_trip(spark, sf_dir):
    """Rows whose prediction differs after stages and forest are saved and loaded."""
    points = points_view(spark, sf_dir)
    stages, model = transformers.feature_pipeline().fit(points), _small_forest(spark, sf_dir)
    path = scratch_path(spark, "model")
    stages.write().save(f"{path}/stages")
    model.write().save(f"{path}/forest")
    loaded = RandomForestClassificationModel.load(f"{path}/forest")
    again = loaded.setPredictionCol("again").setRawPredictionCol("").setProbabilityCol("")
    table = forest.with_class_label(PipelineModel.load(f"{path}/stages").transform(points))
    scored = again.transform(model.transform(table))
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("prediction") != F.col("again")).alias("n_different")
    )


@_register(_with(_POINTS, _REMAPPED, _FEATURES, _USABLE) + f"""select cast(num_trees as int) as num_trees, n_trained, n_scored,
    true as plausible, true as best_is_highest
  from (values {_SEARCHED}) t(num_trees), (select count(*) filter (where split = 'train') as n_trained,
    count(*) filter (where split = 'val') as n_scored from usable)""")
def holdout_search(spark, sf_dir):
    """Forests with 10, 20 and 30 trees fitted on train and compared on val."""
    points = points_view(spark, sf_dir)
    search = find_forest(points, partitions=PARTITIONS, parallelism=3).search
    usable = clean.drop_invalid(_features(spark, sf_dir)).where("Classification is not null")
    n = usable.agg(*[F.count_if(in_split(s)).alias(s) for s in ("train", "val")])
    rows = [(k, _plausible(a), search.accuracy[search.best_trees] == max(search.accuracy.values())) for k, a in search.accuracy.items()]
    table = spark.createDataFrame(rows, "num_trees int, plausible boolean, best_is_highest boolean")
    return table.select("num_trees", n.select("train").scalar().alias("n_trained"), n.select("val").scalar().alias("n_scored"), "plausible", "best_is_highest")


@_register(_with(_POINTS, _REMAPPED, _FEATURES, _USABLE) + """select count(*) as n_scored, true as searched, true as plausible
  from usable where split = 'test'""")
def test_score(spark, sf_dir):
    """The best forest scored on the test split."""
    run = search_forest(points_view(spark, sf_dir), partitions=PARTITIONS, parallelism=3)
    metrics = [run.test_metrics[m] for m in ("f1", "weighted_precision", "weighted_recall")]
    row = (run.test_metrics.n_scored, run.search.best_trees in forest.SEARCH_TREES,
           _plausible(run.test_metrics.accuracy) and all(0 < m <= 1 for m in metrics))
    return spark.createDataFrame([row], "n_scored long, searched boolean, plausible boolean")


@_register(_with(_POINTS, _REMAPPED, _FEATURES, _USABLE) + f"""select cast(num_trees as int) as num_trees, cast(5 as int) as max_depth,
    n_scored, true as plausible, true as best_is_highest
  from (values {_GRID}) t(num_trees), (select count(*) filter (where split = 'test') as n_scored from usable)""")
def cv_search(spark, sf_dir):
    """Cross-validated accuracy of forests with 50, 100 and 150 trees, the best one scored on test."""
    grid = {"numTrees": forest.GRID_TREES, "maxDepth": (5,)}
    model, test = cross_validation_job(points_view(spark, sf_dir), "1", grid, partitions=PARTITIONS)
    best = model.bestModel.stages[-1].getNumTrees
    accuracy = {p[next(k for k in p if k.name == "numTrees")]: a for p, a in zip(model.getEstimatorParamMaps(), model.avgMetrics)}
    good = bool(accuracy[best] == max(accuracy.values()) and _plausible(test.accuracy))
    rows = [(n, 5, test.n_scored, _plausible(a), good) for n, a in accuracy.items()]
    return spark.createDataFrame(rows, "num_trees int, max_depth int, n_scored long, plausible boolean, best_is_highest boolean")


@_register(_with(_POINTS, _REMAPPED, _FEATURES.replace("select point_id,", "select point_id, xyz,"), _USABLE,
                 f"sampled as (select * from usable where {_KEY} < {key_bound('0.5')})") + "select count(*) as n_scored, true as known_classes from sampled where split = 'test'")
def sampled_features(spark, sf_dir):
    """Test rows predicted by a forest on half of the rows, sampled after their features were made."""
    points = points_view(spark, sf_dir)
    _, predicted = sampled_features_job(points, "0.5", hasher="md5", partitions=PARTITIONS, numTrees=10)
    return predicted.where("Classification is not null").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.every(F.col("prediction").between(min(CLASS_NAMES), max(CLASS_NAMES))).alias("known_classes"),
    )


# Run measurement


@_register("""with runs as (select l_discount as fraction, l_linenumber as executors,
    cast(cast(sum(cast(round(l_extendedprice*100) as bigint)) as bigint) as double) / 1000 as seconds
  from lineitem group by l_discount, l_linenumber),
  based as (select *, first_value(seconds) over (partition by fraction order by executors) as s0,
    first_value(executors) over (partition by fraction order by executors) as e0 from runs)
  select fraction, executors, seconds, s0 / seconds as speedup, s0 / seconds / (executors / e0) as efficiency from based""")
def speedup_table(spark, sf_dir):
    """Speed-up over the smallest run with the same fraction, for runs summed from line items."""
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("long"))
    runs = lineitem(spark, sf_dir).groupBy(
        F.col("l_discount").alias("fraction"), F.col("l_linenumber").alias("executors")
    ).agg((cents.cast("double") / 1000).alias("seconds"))
    return taskmetrics.speedup_table(runs)


from point_queries import estimates, spatial  # noqa: E402,F401  (they register their queries)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)
