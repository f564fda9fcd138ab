"""SimHash near-duplicates through Golay-code fuzzy hashing.

A document's fingerprint has 64 bits: a bit is set if more than half of the hashes of its three-word
shingles have it set. Two fingerprints link if at most 3 bits differ.

Fingerprints are split into segments of 22, 21 and 21 bits. Three differing bits leave either one
segment alone and another with at most one differing bit, or one differing bit in each; in the second
case one half of each segment is left alone. So a link is found by a key that holds

* one segment as it is and the code-word index of another one, or
* the code-word index of the first segment and one half as it is of each of the other two.

A segment that may hold one differing bit is decoded to the nearest word of the Golay code. Looked up
are the indices of the segment and of all segments one bit away, at most 6 different ones; stored is
the segment's own index. Links found are verified on the whole fingerprints.

Equal fingerprints are one node from the start. Links are not listed for all pairs of a key: each
looked-up fingerprint is verified against the smallest and the largest stored one of its key, which
joins most of a group of copies in one pass. Only keys whose fingerprints are then still in different
components are joined pair by pair, for pairs in different components, so no link is lost.

Joins that Spark would judge by files or by rows before they are multiplied are by sorting. It goes by the
bytes of packed files and takes a function to return as many rows as it reads; a fingerprint has about fifty
keys, so what it holds small enough to broadcast may be more than the driver's memory.

Null texts and texts without words have fingerprint zero, linked like any other. Rows with the same
doc_id are separate rows with the same or different fingerprints. A component without any doc_id has a
null id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.components import components
from pointlab.llm.golay import index_of, near_indices
from pointlab.llm.shared import written
from pointlab.llm.tokencount import BATCH_BYTES, even_batches

SHINGLE = 3
MOST = 3  # differing bits
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
BLOCK = 1 << 16  # words hashed at once


def _words(data: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, in lists of bounded bytes, whatever the length of the text."""
    start = 0
    while start < len(data):
        end = min(start + most, len(data))
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end].split()
        start = end


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of all shingles, in blocks. A text of fewer words than a shingle is one shingle."""
    held: list[bytes] = []
    some = False
    h = xxhash.xxh64_intdigest
    for words in _words((text or "").encode().lower()):
        held += words
        if len(held) < shingle:
            continue
        some = True
        joined = b" ".join(held)
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        yield np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype=np.uint64)
        held = held[len(held) - shingle + 1 :]
    if held and not some:
        yield np.array([h(b" ".join(held), SEED)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(text, shingle):
        for i in range(0, len(hashes), BLOCK):
            bits = np.unpackbits(hashes[i : i + BLOCK].view(np.uint8), bitorder="little").reshape(-1, 64)
            counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return sum(1 << i for i in range(64) if 2 * counts[i] > total)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry, and fp, the fingerprint as a signed long, for each row of ``docs``."""
    names = ["doc_id", *carry]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_batches(batches, "text", BATCH_BYTES):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(fps.view(np.int64))], [*names, "fp"])

    fields = "".join(f"`{name}` {docs.schema[name].dataType.simpleString()}, " for name in names)
    return docs.select("text", *names).mapInArrow(of, f"{fields}fp long")


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    first, bits = SEGMENTS[i]
    return (fp >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)


def keys_of(fps: np.ndarray, look_up: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``fps`` and their keys: one for each scheme if stored, up to six if looked up."""
    fps = fps.view(np.uint64)
    segments = [_segment(fps, i) for i in range(3)]
    rows, keys = [], []
    if look_up:
        indices = [near_indices(s, bits) for s, (_, bits) in zip(segments, SEGMENTS, strict=True)]
    else:
        indices = [index_of(s)[:, None] for s in segments]
    new = [np.concatenate((np.ones((len(fps), 1), bool), np.diff(x, axis=1) != 0), axis=1) for x in indices]

    def add(scheme: int, segment: int, exact: np.ndarray) -> None:
        at, column = np.nonzero(new[segment])
        rows.append(at)
        keys.append(scheme << 56 | exact[at] << 12 | indices[segment][at, column])

    scheme = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add(scheme, j, segments[i])
                scheme += 1
    half = lambda s, upper: s >> 11 if upper else s & 2047
    for b in (0, 1):
        for c in (0, 1):
            add(scheme, 0, half(segments[1], b) << 11 | half(segments[2], c))
            scheme += 1
    return np.concatenate(rows), np.concatenate(keys)


def keyed(nodes: DataFrame, look_up: bool) -> DataFrame:
    """key, fp: the keys under which each fingerprint is stored or looked up."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for i in range(0, len(fps), 2048):
                own = fps[i : i + 2048]
                rows, keys = keys_of(own, look_up)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(of, "key long, fp long")


def links(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """node, component for the fingerprints of ``nodes`` (fp, all different) that link to another."""
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most
    stored = keyed(nodes, False).groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    # Written, so that the join has a shuffle of its own on either side, which can be split.
    stored = written(stored, "stored")
    # Looked-up fingerprints whose key holds some other one.
    met = written(keyed(nodes, True).join(stored.hint("merge"), "key").where("low <> fp or high <> fp"), "met")
    hubs = met.where(near("fp", "low")).select(F.col("fp").alias("a"), F.col("low").alias("b")).union(
        met.where(near("fp", "high")).select(F.col("fp").alias("a"), F.col("high").alias("b"))
    )
    first = written(hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "hubs")
    named = components(first)
    active = met.select("fp").distinct()
    labels = written(
        active.join(named.hint("merge"), active.fp == named.node, "left").select("fp", F.coalesce("component", "fp").alias("component")), "labels"
    )
    looked = met.select("key", "fp").join(labels.hint("merge"), "fp")
    kept = keyed(labels, False).join(labels.hint("merge"), "fp").select("key", F.col("fp").alias("other"), F.col("component").alias("of_other"))
    mixed = (
        looked.select("key", "component").union(kept.select("key", "of_other"))
        .groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    )
    rest = looked.join(mixed, "key", "left_semi").join(kept, "key").where((F.col("component") != F.col("of_other")) & near("fp", "other"))
    second = rest.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()
    return components(first.union(second))


def classes(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """doc_id, the columns to carry and fp of every row of ``docs``, and component, one of its
    fingerprints, of every fp."""
    if not 0 <= most <= MOST:
        raise ValueError(f"keys hold for 0 to {MOST} differing bits")
    fps = written(fingerprints(docs, shingle, carry), "fps")
    nodes = fps.select("fp").distinct()
    linked = written(links(nodes, most), "components")
    return fps, nodes.join(linked.hint("merge"), nodes.fp == linked.node, "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id of its component) for each row of ``docs``."""
    fps, of = classes(docs, shingle, most)
    labelled = fps.groupBy("fp").agg(F.min("doc_id").alias("first")).join(of.hint("merge"), "fp")
    first = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = labelled.join(first, "component").select("fp", "component_id")
    return fps.join(by_fp.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
