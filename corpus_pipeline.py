"""A text corpus made ready in five stages: language, repeated lines, near copies, mix, token ids.

Every stage but the last returns the columns of ``documents``. Each works on all that the one before it
kept; between stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.llm import bpe, langid, linededup, mixing, simhash
from pointlab.llm.queries import VOCABULARY
from pointlab.llm.shared import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go; ``lang`` becomes the language found.

    Null texts, and texts without a letter, have no language and go. Repeated rows and ties are judged row by
    row; very long texts are read in blocks. An empty table, or one without a labelled text, gives no model
    and leaves no row. Columns beyond those of ``documents`` pass through, whatever their name."""
    models = langid.train(docs)
    found = langid.identify(docs, models, ("__lang", "__score", "__entropy", "__rejected")).where("not __rejected")
    return found.select(*[F.col("__lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three repeated lines go, and documents of which nothing is left by that; ``n_chars`` is
    that of the new text.

    Null and empty texts stay as they are. Of repeated rows one is the first occurrence, the smallest doc_id is
    (null last; then text hash), so copies go. Texts of any length count whole. An empty table stays empty;
    further columns pass through."""
    done = linededup.dedup_lines(docs, removed="__removed").where("__removed = 0 or trim(BOTH FROM text) <> ''")
    return done.select(*[F.char_length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies stays, the one with the smallest doc_id (null last; then by
    text hash).

    Shingle length and bit distance are those of the operator's contract. Null and empty texts have fingerprint
    zero and are one group. Rows that repeat doc_id and text are one document, of which any one row stays. Very long
    texts are hashed in blocks. An empty table stays empty; further columns pass through."""
    keyed = docs.withColumns({"__null": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)), "__text": F.xxhash64("text")})
    key = ["__null", "__id", "__text"]
    fps, classes = simhash.classes(keyed, simhash.SHINGLE, simhash.MOST, carry=tuple(key))
    # The first of each fingerprint, then of each class: a fingerprint that many share is never joined.
    own = fps.groupBy("fp").agg(F.min(F.struct(*key)).alias("first"))
    first = own.join(classes.hint("merge"), "fp").groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    # Repeated rows share a key, of which one row stays.
    return keyed.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most twice.

    Null and empty texts have size 0 and are taken by their rank like any other. Ties are dealt by a hash of the
    doc_id; repeated rows have ranks of their own. A null source is a source. An empty table stays empty; further
    columns pass through."""
    rows = docs.select("doc_id", "source", mixing.word_count().alias("size"), F.struct(*docs.columns).alias("row"))
    mixed = mixing.mix(rows).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and of decoded texts, one row for each row.

    Null texts count as empty: no tokens. Very long texts are cut into chunks; repeated rows and texts are encoded
    once and returned row by row. An empty table gives none. Further columns are not read."""
    return bpe.encode_decode(docs, VOCABULARY)


STAGES = [
    ("language", language),
    ("line dedup", lines),
    ("near copies", near_copies),
    ("mix", mix),
    ("token ids", tokens),
]

# Language models, fingerprints by XXH64 and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
