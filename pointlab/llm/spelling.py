"""Spelling variants among the words of a corpus, by a relational trie frontier.

Words are runs of letters with A-Z in lower case, counted over all texts. The words form a trie that is a table of
edges: its nodes are the beginnings where words part or end, an edge carries the letters up to the next
node. Search states (word, position, node, edits) start at the root, all words at once, and are joined with
the edges level by level: without an edit so far a state follows the edge that the word matches, every edge that
it matches with one letter replaced by a larger one, and those that it matches with one letter deleted; with one
edit only the edge it matches exactly. A state at the end of its word and of another one, with one edit, makes
both neighbours. An inserted letter is a deleted one seen from the other word, and a smaller letter a larger one, so
each pair is found from one side.

A node is named by a 64-bit hash of its beginning. Beginnings that share a name would share edges: no
neighbour is lost by it, and pairs are verified at the end. States without an edit are joined with all edges of
their node as one row (at most one edge for each letter), states with one edit with the edge of their next letter, so
both joins have one row a key on that side and adaptive execution can split what is hot, such as the root,
where all words start. States that cannot go on are not made: the
first letters behind each edge are known. There are as many levels as nodes on the longest way, not as
letters in the longest word.

A word's form is its most frequent neighbour (ties: smallest in code-point order), if that is at least
``ratio`` times as frequent as the word; forms are followed to the last by pointer doubling.

Null texts have no words; a doc_id that is null counts as ''. Repeated rows count as often as they
are there. Very long words are words; a word of n letters costs n rows once. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.llm.shared import text_or_empty, written
from pointlab.llm.tokencount import BATCH_BYTES, even_batches

RUN = re.compile("[a-zÀ-ÿ]+")
TYPO = 199  # one in so many runs loses a letter
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
ROOT = 0


def count_runs(docs: DataFrame, typo: int = TYPO) -> DataFrame:
    """word, n: how often each run occurs, after one letter was taken out of every run whose hash ``typo`` divides."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_batches(batches, "text", BATCH_BYTES):
            found: Counter[str] = Counter()
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                runs = (m.group() for m in RUN.finditer(text.encode().lower().decode()))
                found.update(_typed(run, zlib.crc32(run.encode(), start), typo) for run in runs)
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text_or_empty().alias("text"))
    return rows.mapInArrow(of, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _typed(run: str, h: int, typo: int) -> str:
    if h % typo:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def beginnings(words: DataFrame) -> DataFrame:
    """word, size, node, after: each beginning of a word (size letters) but the empty one, with the letter after it ('' at its end)."""
    factor = np.uint64(0x9E3779B97F4A7C15)

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in even_batches(iter([whole]), "word", 1 << 16):
                words = batch.column("word").to_pylist()
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                letters = "".join(words)
                codes = np.frombuffer(letters.encode("utf-32-le"), np.uint32).astype(np.uint64)
                owner, start = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
                size = np.arange(len(codes)) - start + 1
                # The sum of one hash for each letter at its place names a beginning.
                with np.errstate(over="ignore"):
                    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(codes + size.astype(np.uint64) * factor), dtype=np.uint64)))
                    node = sums[1:] - sums[start]
                after = list(letters[1:] + " ")
                for i in (np.cumsum(sizes) - 1).tolist():
                    after[i] = ""
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(pa.array(owner)), pa.array(size, pa.int32()), pa.array(node.view(np.int64)), pa.array(after, pa.string())],
                    ["word", "size", "node", "after"],
                )

    return words.select("word").mapInArrow(of, "word string, size int, node long, after string")


def trie(words: DataFrame) -> DataFrame:
    """node, letter, label, child, ends, next: the edges of the trie of ``words`` (word, n).

    An edge has a label (letters, the first of which is ``letter``), a child (node), the word and n of the word that ends
    there (or null) and the first letters behind the child."""
    all_ = written(beginnings(words), "beginnings")
    parts = all_.groupBy("node").agg(F.collect_set("after").alias("after"))
    nodes = written(
        parts.where((F.size("after") > 1) | F.array_contains("after", "")).select("node", F.array_join("after", "").alias("next")), "nodes"
    )
    # The nodes on the way of each word, in order, and the word and its count at its end.
    way = all_.join(nodes, "node").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("size", "node", "next"))).alias("way"))
    steps = way.join(words, "word").select("word", "n", F.posexplode("way").alias("i", "to"), "way").select(
        F.when(F.col("i") == 0, F.lit(ROOT)).otherwise(F.get("way.node", F.col("i") - 1)).alias("node"),
        F.when(F.col("i") == 0, F.lit(0)).otherwise(F.get("way.size", F.col("i") - 1)).alias("from"),
        "word", "n", "to",
    )
    edge = F.substring(F.col("word"), F.col("from") + 1, F.col("to.size") - F.col("from"))
    ends = F.when(F.col("to.size") == F.char_length("word"), F.struct("word", "n"))
    return (
        steps.select("node", edge.alias("label"), F.col("to.node").alias("child"), ends.alias("ends"), F.col("to.next").alias("next"))
        .groupBy("node", "label", "child").agg(F.first("ends", ignorenulls=True).alias("ends"), F.first("next").alias("next"))
        .select("node", F.substring("label", 1, 1).alias("letter"), "label", "child", "ends", "next")
    )


def _state(edge: Column, position: Column, edits: int) -> Column:
    return F.struct(edge["child"].alias("node"), position.alias("position"), F.lit(edits).alias("edits"), edge["ends"].alias("ends"), edge["next"].alias("next"))


def _follow(edge: Column, rest: Column, position: Column) -> Column:
    """States at the end of an edge, from a word without an edit so far of which ``rest`` is left at ``position``."""
    label = edge["label"]
    size, left, own = F.char_length(label), F.char_length(rest), F.substring(rest, F.lit(1), F.char_length(label))
    # Of two texts of one length that differ by one letter, the larger one has the larger letter.
    replaced = (left >= size) & (label > own) & ((size == 1) | (F.levenshtein(label, own, 1) == 1))
    first = F.substring(label, 1, 1)
    begins = (first == F.substring(rest, 1, 1)) | (first == F.substring(rest, 2, 1))
    deleted = (left > size) & begins & (F.levenshtein(label, F.substring(rest, F.lit(1), size + 1), 1) == 1)
    return F.array(
        F.when(F.startswith(rest, label), _state(edge, position + size, 0)),
        F.when(replaced, _state(edge, position + size, 1)),
        F.when(deleted, _state(edge, position + size + 1, 1)),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: every two words (word, n) that differ by one letter, both ways round."""
    edges = written(trie(words), "trie")
    nodes = written(edges.groupBy("node").agg(F.collect_list(F.struct("label", "child", "ends", "next")).alias("edges")), "nodes")
    states = words.select("word", "n", F.lit(ROOT).cast("long").alias("node"), F.lit(0).alias("position"), F.lit(0).alias("edits"))
    rest = F.substring(F.col("word"), F.col("position") + 1, F.char_length("word"))
    pairs = None
    while True:
        plain, edited = states.where("edits = 0"), states.where("edits = 1")
        branched = (
            plain.join(nodes, "node").select("word", "n", F.explode("edges").alias("edge"), "position", rest.alias("rest"))
            .select("word", "n", F.explode(_follow(F.col("edge"), F.col("rest"), F.col("position"))).alias("s"))
            .where("s is not null").select("word", "n", "s.*")
        )
        followed = (
            edited.select("word", "n", "node", "position", rest.alias("rest"), F.substring(rest, 1, 1).alias("letter"))
            .join(edges, ["node", "letter"]).where(F.startswith("rest", "label"))
            .select("word", "n", _state(F.struct("child", "ends", "next"), F.col("position") + F.char_length("label"), 1).alias("s")).select("word", "n", "s.*")
        )
        reached = branched.unionByName(followed)
        over = F.col("position") == F.char_length("word")
        # What goes on needs an edge for its next letter.
        ahead = F.instr(F.col("next"), F.substring(F.col("word"), F.col("position") + 1, F.lit(1))) > 0
        found = over & (F.col("edits") == 1) & F.col("ends").isNotNull()
        level = written(reached.where(found | (~over & ahead)), "frontier")
        new = level.where(found).select("word", "n", F.col("ends.word").alias("other"), F.col("ends.n").alias("other_n"))
        pairs = new if pairs is None else pairs.unionByName(new)
        states = level.where(~over).select("word", "n", "node", "position", "edits")
        if states.isEmpty():
            break
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    # A pair may be found on several ways, as where one of two equal letters is deleted.
    return both.where(F.levenshtein("word", "other", 1) == 1).groupBy("word", "other").agg(F.first("n").alias("n"), F.first("other_n").alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms (word, form) that follow from each word that has one."""
    own = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = own.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        further = written(own.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        if further.where("moved").isEmpty():
            return further.drop("moved")
        own = further.drop("moved")


def variants(docs: DataFrame, *, typo: int = TYPO, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of at least ``min_letters`` letters and ``min_count`` occurrences."""
    words = written(count_runs(docs, typo).where((F.char_length("word") >= min_letters) & (F.col("n") >= min_count)), "words")
    best = neighbours(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    near = words.join(best, "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    formed = written(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(has_form, F.col("best.other")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n")), "formed"
    )
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
