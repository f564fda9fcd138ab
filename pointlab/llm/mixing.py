"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target words over words of the
source. The running sum of expected copies over an ordered source, shifted by one random offset per
source, crosses integers; a document is emitted once per integer that it crosses. Documents are
ordered by size class first, so that the words taken follow the target closely.

The running sum is the rank times the expected copies. Ranks are made in levels, so that a source may
hold any share of the rows: counts of buckets are summed up per source, counts of sizes and further
digits per bucket, and only inside those are documents ranked. Rows that agree in source, size and
doc_id are one document with a count there, so neither ids that repeat nor missing ones fill a task;
where they differ in other columns, a hash of these deals them to parts that are counted in the same
way. Whole rows are shuffled once, copies of one combined before.

Rows whose source is null form a source of their own, the last one. Texts that are null or without
words have size 0; a source without words has target 0 and emits nothing. Equal rows are ranked one
after the other, so each may be taken. Input columns that carry the name of a result column are
replaced; other columns are kept, of any type that Spark hashes. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlab.llm.shared import WORD, text_or_empty, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all words
LIMIT = 2.0  # copies of a source at most
SEED = 7
RESULTS = ("source_size", "target", "copies", "taken")
KEY = ["source", "size", "doc_id"]
PARTS = 256  # of rows that agree in KEY but not in other columns
CHUNK = 4096  # copies of a row written out at once


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def _order(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))


def _size_class() -> Column:
    """Eight classes for each doubling of the size, in order of the size."""
    bits = F.length(F.bin("size"))
    return bits * 8 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0)) % 8").cast("int")


def _offset(source: str, seed: int) -> Column:
    """Between 0 and 1, from the seed and the source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """One row per source: source, source_size, target. ``rows`` has source and size.

    Targets are proportional to the weights, except for sources that reach ``limit`` times their
    size: ordered by limit over weight, the first source whose limit is not exceeded by an even share
    of what is left sets the level for all after it. Needs share <= limit.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy("room", F.col("source").isNull(), "source")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("at", (F.row_number().over(by_name) - 1) % len(weights)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("at").cast("int") + 1)
    )
    room = ranked.withColumn("room", limit * F.col("source_size") / F.col("weight"))
    everything = Window.partitionBy()
    level = (
        room.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("before_size", F.coalesce(F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("before_weight", F.coalesce(F.sum("weight").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (share * F.col("all_size") - limit * F.col("before_size")) / (F.col("all_weight") - F.col("before_weight")))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "level"))).over(everything)["level"])
    )
    capped = F.least(limit * F.col("source_size"), F.col("level") * F.col("weight"))
    return level.select("source", "source_size", F.coalesce(capped, F.lit(0.0)).alias("target"))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], large: bool = False) -> DataFrame:
    """``left`` with the further columns of ``right``; nulls of the keys are equal.

    With ``large``, for tables that both grow with the corpus, by sorting: Spark judges them by the packed file of the
    counts, a few bytes a row, and keeps to a broadcast that turns out too large if sorting takes more shuffles."""
    other = right.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    other = other.hint("merge") if large else other
    return left.join(other, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]).drop(*[f"__of_{k}" for k in keys])


def _marked(column: Column, kind: T.DataType) -> list[Column]:
    """What to hash of a column. Nulls leave a hash as it is, so they are marked."""
    if isinstance(kind, T.StructType):
        return [column.isNull()] + [x for f in kind.fields for x in _marked(column[f.name], f.dataType)]
    nulls = F.to_json(column, {"ignoreNullFields": "false"}) if isinstance(kind, T.ArrayType) else column.isNull()
    return [column, nulls]


def _before(counts: DataFrame, inside: list[str], order: list[str], name: str) -> DataFrame:
    """``name``: the sum of __n over earlier rows of the same ``inside``."""
    return counts.withColumn(name, F.sum("__n").over(Window.partitionBy(*inside).orderBy(*order)) - F.col("__n"))


def _starts(counts: DataFrame, seed: int) -> DataFrame:
    """KEY and __start, the number of rows of the source before, for each document of ``counts`` (KEY, __n)."""
    documents = counts.groupBy(*KEY).agg(F.sum("__n").alias("__n")).withColumn("__order", _order("doc_id", seed))
    placed = (
        documents.withColumn("__class", _size_class())
        .withColumn("__bucket", F.substring("__order", 1, 1))
        .withColumn("__digits", F.substring("__order", 2, 3))
    )
    coarse, fine = ["source", "__class", "__bucket"], ["source", "__class", "__bucket", "size", "__digits"]
    fines = placed.groupBy(*fine).agg(F.sum("__n").alias("__n"))
    # Rows of one source in one task here are its buckets: at most 16 for each size class.
    coarses = _before(fines.groupBy(*coarse).agg(F.sum("__n").alias("__n")), ["source"], ["__class", "__bucket"], "__a").drop("__n")
    fines = _joined(_before(fines, coarse, ["size", "__digits"], "__b").drop("__n"), coarses, coarse)
    ranked = _joined(_before(placed, fine, ["__order", "doc_id"], "__c"), fines, fine, large=True)
    return ranked.select(*KEY, (F.col("__a") + F.col("__b") + F.col("__c")).alias("__start"))


def mix(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED) -> DataFrame:
    """``rows`` (doc_id, source, size, and any others) with source_size, target, copies and taken."""
    kept = [c for c in rows.columns if c.lower() not in RESULTS]
    others = [c for c in kept if c not in KEY]
    # Two hashes name a row.
    marked = [x for c in kept for x in _marked(F.col(c), rows.schema[c].dataType)]
    name = {f"__h{i}": F.xxhash64(F.lit(i), *marked) for i in range(2)} if others else {}
    named = rows.select(*KEY, *[h.alias(c) for c, h in name.items()], *([F.struct(*others).alias("__row")] if others else []))
    counts = written(named.groupBy(*KEY, *name).agg(F.count(F.lit(1)).alias("__n")), "counts")
    starts = _starts(counts, seed)
    if others:
        parts = counts.withColumn("__part", F.pmod("__h0", F.lit(PARTS)))
        inside = [*KEY, "__part"]
        sums = _before(parts.groupBy(*inside).agg(F.sum("__n").alias("__n")), KEY, ["__part"], "__d").drop("__n")
        numbered = _joined(_before(parts, inside, [*name], "__e"), sums, inside, large=True)
        starts = _joined(numbered, starts, KEY).withColumn("__start", F.col("__start") + F.col("__d") + F.col("__e"))
    else:
        starts = _joined(counts, starts, KEY, large=True)
    sizes = counts.select("source", (F.col("size") * F.col("__n")).alias("size"))
    targets = source_targets(sizes, weights, share, limit)
    chunks = (
        _joined(starts.select(*KEY, *name, "__start", "__n"), targets, ["source"])
        .withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / CHUNK))))
        .withColumn("__start", F.col("__start") + F.col("__chunk") * CHUNK)
        .withColumn("__n", F.least(F.lit(CHUNK), F.col("__n") - F.col("__chunk") * CHUNK))
    )
    if others:
        whole = named.groupBy(*name).agg(F.first("__row").alias("__row"))
        chunks = whole.join(chunks, [*name]).select("*", *[F.col("__row")[c].alias(c) for c in others])
    else:  # the copies of one document are dealt to tasks by their chunk
        chunks = chunks.repartition("doc_id", "size", "__chunk")
    rank = F.col("__start") + F.col("__rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor(rank * F.col("__rate") + F.col("__u")) - F.floor((rank - 1) * F.col("__rate") + F.col("__u"))
    return (
        chunks.withColumn("__rate", rate).withColumn("__u", _offset("source", seed))
        .withColumn("__rank", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
        .withColumn("copies", crossed.cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*kept, *RESULTS)
    )


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS o
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS room FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
v AS (SELECT arg_min(level, room) AS level FROM l WHERE level <= room),
t AS (SELECT source, source_size, coalesce(least(2.0::DOUBLE * source_size, v.level * weight), 0.0)::DOUBLE AS target,
    ('0x' || substr(md5('{SEED}:' || coalesce('s' || source, 'n')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM r, v),
k AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(d.size)) * 8 + (d.size >> greatest(length(bin(d.size)) - 4, 0)) % 8, substr(o, 1, 1), d.size, o, d.doc_id) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(n * rate + u) - floor((n - 1) * rate + u)) * size)::BIGINT AS taken FROM k
"""
