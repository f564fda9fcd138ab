"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words and how often each occurs. For every word and every one of the
``samples`` positions, hashes give two Gamma(2, 1) numbers r and c and a uniform b. A word of weight S
has t = floor(ln S / r + b), y = exp(r (t - b)) and a = c / (y exp(r)); the position keeps the word and
t of the smallest a. Two texts agree at a position with a probability equal to their generalised
Jaccard similarity, the sum of smaller weights over the sum of larger ones; the share of equal positions
estimates it. A position is written as 8 hex digits of a hash of (word, t).

Words are counted and sampled where a document's row already lies, so only texts, and later
fingerprints, are shuffled, never words. The order of documents is made from a range-partitioned
table of ids, written once, with the first id of each partition passed on to the one before.

Null texts count as empty. Texts without words have fingerprint zero in all positions and are alike
(1.0) only to one another. Rows that repeat doc_id and text are one document in the order, with a count
made before its text is shuffled, and are answered alike, each row once. A null doc_id comes last in
descending order, after every number. The only document is its
own next. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlab.llm.shared import text_or_empty, written

SAMPLES = 32
KEY = ["no", "id", "t"]  # without an id, the id, a hash of the text
CHUNK = 4096  # copies of a row written out at once
STEP = 1 << 21


def _uniform(h: Column, first: int) -> Column:
    """From 21 bits of a hash, never 0 or 1."""
    return (F.shiftrightunsigned(h, first).bitwiseAND(F.lit(STEP - 1)) + F.lit(0.5)) / F.lit(float(STEP))


def sample(term: str, weight: str, i: int) -> Column:
    """ln a in the upper 32 bits, in an order-preserving form, and a hash of (term, t) in the lower ones."""
    h = F.xxhash64(term, F.lit(2 * i))
    g = F.xxhash64(term, F.lit(2 * i + 1))
    r = -F.ln(_uniform(h, 0) * _uniform(h, 21))
    c = -F.ln(_uniform(h, 42) * _uniform(g, 0))
    b = _uniform(g, 21)
    t = F.floor(F.ln(F.col(weight)) / r + b)
    ln_a = F.ln(c) - r * (t - b) - r
    high = F.floor((ln_a + 128) * (1 << 23)).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(term, t).bitwiseAND(F.lit(0xFFFFFFFF)))


def signatures(texts: DataFrame, key: list[str], samples: int = SAMPLES, numbers: bool = False) -> DataFrame:
    """``key``, sig, an array of ``samples`` longs, and number, for every row of ``texts`` (key, text) that has a word.

    Rows have to be partitioned by some of the ``key`` columns for words to stay where they are. With
    ``numbers``, texts of a kind (a column of ``key``) from 2 on are whole numbers, which come out as number."""
    words = texts.select(*key, F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    hashed = F.xxhash64("word")
    term = F.when(F.col("kind") < 2, hashed).otherwise(F.col("word").try_cast("long")) if numbers else hashed
    weighted = words.select(*key, term.alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("weight"))
    least = weighted.groupBy(*key).agg(
        *[F.min(sample("term", "weight", i)).alias(f"s{i}") for i in range(samples)], F.max("term").alias("number")
    )
    sig = F.array(*[F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(samples)])
    return least.select(*key, sig.alias("sig"), "number")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal positions."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(samples))


def hex_of(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.isNull().cast("int").alias("no"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("t"), text.alias("text")
    )


def following(docs: DataFrame) -> DataFrame:
    """KEY, next_no, next_id, next_t, n_chars: every document and the next one in descending order of ids."""
    order = [F.col("no").asc(), F.col("id").desc(), F.col("t").asc()]
    ids = _keyed(docs).select(*KEY, F.char_length("text").cast("long").alias("n_chars")).distinct()
    ranged = ids.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "order")
    inside = Window.partitionBy("part").orderBy(*order)
    placed = ranged.withColumn("next", F.lead(F.struct(*KEY)).over(inside)).withColumn("nth", F.row_number().over(inside))
    # One row for each partition of the range.
    firsts = placed.where("nth = 1").select("part", F.struct(*KEY).alias("first"))
    parts = Window.partitionBy().orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(parts)).alias("after"))
    return placed.join(after, "part").withColumn("next", F.coalesce("next", "after")).select(
        *KEY, "n_chars", *[F.col("next")[c].alias(f"next_{c}") for c in KEY]
    )


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each
    row of ``docs``. The edited text has the last half of its characters replaced by the first
    characters, as many or all, of the next document."""
    key, nexts_key = KEY, [f"next_{c}" for c in KEY]
    order = written(following(docs), "following")
    # Equal rows are combined before they are shuffled. The filter keeps the count in both uses, so that they share one shuffle.
    texts = _keyed(docs).groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")).where("copies > 0")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    ends = texts.alias("x").join(order.alias("o"), [F.col(f"x.{c}") == F.col(f"o.next_{c}") for c in key]).select(
        *[F.col(f"o.{c}").alias(c) for c in key], "n_chars", *nexts_key, F.substring("text", F.lit(1), half).alias("end"),
    )
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), "end")
    pairs = texts.join(ends, key).withColumn("edited", edited).withColumn("sha", F.sha2("edited", 256))
    # What else is known of a document goes along as numbers, so that texts are put together once.
    facts = {c: F.col(c).cast("string") for c in ("copies", "n_chars", *nexts_key)}
    facts |= {f"sha{i}": F.conv(F.substring("sha", 16 * i + 1, 16), 16, -10) for i in range(4)}
    kinds = [F.col("text"), F.col("edited"), *facts.values()]
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), text.alias("text")) for k, text in enumerate(kinds)])
    each = signatures(pairs.select(*key, F.explode(kinds).alias("x")).select(*key, "x.kind", "x.text"), [*key, "kind"], samples, numbers=True)
    wide = each.groupBy(*key).agg(
        *[F.max(F.when(F.col("kind") == k, F.col("number"))).alias(c) for k, c in enumerate(facts, 2)],
        *[F.first(F.when(F.col("kind") == k, F.col("sig")), ignorenulls=True).alias(f"sig{k}") for k in (0, 1)],
    )
    empty = F.array_repeat(F.lit(0).cast("long"), samples)
    sha = F.concat(*[F.lower(F.lpad(F.hex(f"sha{i}"), 16, "0")) for i in range(4)])
    known = written(wide.select(
        *key, "copies", "n_chars", *nexts_key, sha.alias("edited_sha256"),
        F.coalesce("sig0", empty).alias("sig0"), F.coalesce("sig1", empty).alias("sig1"),
    ), "signatures")
    nexts = known.select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("sig0").alias("sig_next"))
    chunks = known.join(nexts, nexts_key).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK))))
    left = F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK)
    rows = chunks.withColumn("copy", F.explode(F.sequence(F.lit(1), left.cast("int"))))
    return rows.select(
        F.when(F.col("no") == 0, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
        hex_of(F.col("sig0")).alias("fingerprint"), hex_of(F.col("sig1")).alias("edited_fingerprint"),
        likeness(F.col("sig0"), F.col("sig1"), samples).alias("near_edited"), likeness(F.col("sig0"), F.col("sig_next"), samples).alias("near_next"),
    )
