"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines form a window, named by 128 bits of hash. A window that occurs more
than once, anywhere, is kept where it occurs first (smallest doc_id, null last; then text hash; then
place in the text); every later occurrence covers its three lines. Covered places of a document are
merged into intervals, and the lines outside them, joined again, are the new text.

Only hashes and places are shuffled for the search; texts move once, to meet their places. A window
that a third of all documents hold is combined before the shuffle, and the join back to it is one
that adaptive execution can split.

Null texts stay null. Texts of fewer than three lines have no window and stay as they are. Windows of
blank lines only are left alone. Of rows that repeat both doc_id and text one is the first, and all windows
of the others are later occurrences; among rows that differ in other columns it is the one with the smallest
hash of them. Such rows are counted, not listed. Extra columns are kept, whatever their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.llm.shared import written

LINES = 3
CHUNK = 10_000  # copies of a row written out in one go


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__id", F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))).withColumn("__text", F.xxhash64("text"))


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """__id, __text, at (from 0), w1, w2: one row for each window that is not blank."""
    hashed = _keyed(docs.where(F.col("text").contains("\n"))).select(
        "__id", "__text", F.transform(F.split("text", "\n"), lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) == "").alias("e"))).alias("h"),
    )
    count = F.size("h") - (lines - 1)
    shifted = hashed.where(count > 0).select(
        "__id", "__text", F.posexplode(F.arrays_zip(*[F.slice("h", i + 1, count).alias(f"l{i}") for i in range(lines)])).alias("at", "w"),
    )
    blank = F.lit(True)
    for i in range(lines):
        blank = blank & F.col(f"w.l{i}.e")
    return shifted.where(~blank).select(
        "__id", "__text", "at",
        F.xxhash64(*[f"w.l{i}.a" for i in range(lines)]).alias("w1"),
        F.xxhash64(*[f"w.l{i}.b" for i in range(lines)]).alias("w2"),
    )


def later_places(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """__id, __text, __places: where later occurrences of repeated windows begin, in order, in the first row of each doc_id and text."""
    found = windows(docs, lines)
    here = F.struct("__id", "__text", "at")
    first = (
        found.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("first"))
        .where("n > 1").select("w1", "w2", "first")
    )
    # Written, so that the join has a shuffle of its own on either side, which can be split.
    first = written(first, "windows")
    return (
        found.join(first, ["w1", "w2"]).where(here != F.col("first"))
        .groupBy("__id", "__text").agg(F.array_sort(F.collect_set("at")).alias("__places"))
    )


def _all_places(lines: int) -> Column:
    """Where the windows of ``text`` that are not blank begin."""
    split = F.transform(F.split("text", "\n"), lambda x: F.trim(x) != "")
    places = F.sequence(F.lit(0), F.size(split) - lines)
    return F.when(F.size(split) >= lines, F.filter(places, lambda i: F.exists(F.slice(split, i + 1, lines), lambda x: x)))


def _repeated(docs: DataFrame) -> DataFrame:
    """__of, __also: doc_id and text hash of rows of more than one line that are there twice or more."""
    keyed = _keyed(docs.where(F.col("text").contains("\n")))
    return keyed.groupBy("__id", "__text").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(F.col("__id").alias("__of"), F.col("__text").alias("__also"))


def _copies(rows: DataFrame, columns: list[str], lines: int) -> DataFrame:
    """Repeated rows with the places of one that is the first, and all places for the others."""
    own = F.struct(F.xxhash64(F.lit(0), *columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    counted = rows.groupBy("__id", "__text", own.alias("__row")).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*columns)).alias("__data"), F.any_value("__places").alias("__places")
    )
    # Written: what is the first row is found once for all.
    counted = written(counted, "copies")
    least = counted.groupBy(F.col("__id").alias("__of"), F.col("__text").alias("__also")).agg(F.min("__row").alias("__least"))
    marked = counted.join(least, (F.col("__id") == F.col("__of")) & (F.col("__text") == F.col("__also")))
    is_first = F.col("__row") == F.col("__least")
    # Chunks of copies are spread over tasks before they are written out.
    chunks = marked.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / CHUNK)))).repartition(F.col("__row.a"), F.col("__chunk"))
    left = F.least(F.lit(CHUNK), F.col("__n") - F.col("__chunk") * CHUNK)
    one = chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1), left)))
    first = is_first & (F.col("__chunk") == 0) & (F.col("__copy") == 1)
    return one.select("__data.*", "__places", first.alias("__first")).withColumn(
        "__places", F.when(F.col("__first"), F.col("__places")).otherwise(_all_places(lines))
    ).select(*columns, "__places")


def _without(rows: DataFrame, columns: list[str], lines: int, removed: str) -> DataFrame:
    """``columns`` of the rows with the new text, and the number of lines removed."""
    p = F.col("__places")
    merged = rows.withColumn(
        "__from", F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) < x - lines))
    ).withColumn(
        "__to", F.transform(F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) > x + lines)), lambda x: x + lines)
    ).withColumn("__lines", F.when(p.isNotNull(), F.split("text", "\n")))
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0)), "__to"), F.concat("__from", F.array(F.size("__lines"))),
        lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")),
    )
    left = F.flatten(F.transform(gaps, lambda g: F.slice(F.col("__lines"), g["a"] + 1, g["n"])))
    covered = F.aggregate(F.zip_with("__from", "__to", lambda a, b: b - a), F.lit(0), lambda s, x: s + x)
    return merged.select(
        *[F.when(p.isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias(c) if c == "text" else F.col(c) for c in columns],
        F.coalesce(F.when(p.isNotNull(), covered), F.lit(0)).alias(removed),
    )


def dedup_lines(docs: DataFrame, lines: int = LINES, removed: str = "lines_removed") -> DataFrame:
    """``docs`` with the new text, and the number of lines removed (replacing a column of that name)."""
    kept = [c for c in docs.columns if c.lower() != removed]
    places = later_places(docs, lines)
    rows = _keyed(docs.select(*kept))
    joined = rows.join(places, ["__id", "__text"], "left")
    # Two or more rows of one doc_id and text are rare; without any there is nothing to tell apart.
    repeated = written(_repeated(docs), "repeated")
    if repeated.isEmpty():
        return _without(joined, kept, lines, removed)
    same = (F.col("__id") == F.col("__of")) & (F.col("__text") == F.col("__also"))
    single = joined.join(repeated, same, "left_anti")
    again = rows.join(repeated, same, "left_semi").join(places, ["__id", "__text"], "left")
    return _without(single, kept, lines, removed).unionByName(_without(_copies(again, kept, lines), kept, lines, removed))


ORACLE = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM d),
w AS (SELECT r, i, line || chr(10) || lead(line, 1) OVER q || chr(10) || lead(line, 2) OVER q AS w FROM l WINDOW q AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, i, row_number() OVER (PARTITION BY w ORDER BY r, i) AS nth FROM w WHERE w IS NOT NULL AND trim(w, ' ' || chr(10)) <> ''),
c AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM n WHERE nth > 1),
k AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL) AS text, count(c.i) AS gone FROM l LEFT JOIN c ON l.r = c.r AND l.i = c.i GROUP BY l.r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.gone, 0)::INT AS lines_removed
FROM d LEFT JOIN k ON d.r = k.r
"""
