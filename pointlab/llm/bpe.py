"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 32 bytes cuts texts where its upper bits are zero, so that passages
which documents share are cut alike. Chunks that occur more than once anywhere are encoded once, and
their ids are joined back to every place. Chunks that occur once are encoded where they are, together
with their neighbours of that kind. Wherever two separately encoded parts meet, the ids around the
join are replaced by those of a re-encoded stretch, which is widened until its ends are token
boundaries on both sides at places where no token can span; the result is that of encoding the whole
text.

Which chunks occur more than once is found by counting hashes. The tasks that read the texts know it
from a bit table of a fixed size, ``2**table_bits`` bits, made by an aggregation. A chunk that the
table names wrongly is treated as a repeated one, which costs a shuffle of it and changes no result.
Documents without repeated chunks are done in the task that reads them; of the others, the parts are
written to the shared folder once, repeated chunks are met by hash, and documents are put together by
row. A chunk in a third of all documents is combined before its shuffle, and the join back to its
places is one that adaptive execution can split.

Only byte-level vocabularies (.json) are taken. Null texts count as empty: no ids, the hash of
nothing. Every row is answered for itself, repeated rows and null doc_ids too. Extra columns are not
read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.encoder import encoder
from pointlab.llm.shared import written
from pointlab.llm.tokencount import BATCH_BYTES, even_batches

MASK_BITS = 10  # chunks of 2**10 bytes on average
TABLE_BITS = 24  # 2 MiB
WINDOW = 5  # 2**5 bytes
FACTOR = 0x9E3779B97F4A7C15


@functools.cache
def _gear() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(bytes([i]), seed=1) for i in range(256)], dtype=np.uint64)


def cuts(data: bytes, mask_bits: int = MASK_BITS) -> list[int]:
    """Where chunks end, the end of the text last. Never inside a UTF-8 character."""
    raw = np.frombuffer(data, dtype=np.uint8)
    h = _gear()[raw]
    for k in range(WINDOW):  # doubles the window each time
        step = 1 << k
        if len(h) > step:
            h[step:] += h[:-step] * np.uint64(pow(FACTOR, step, 1 << 64))
    ends = np.flatnonzero(h >> np.uint64(64 - mask_bits) == 0) + 1
    out = []
    for end in ends.tolist():
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end < len(data) and (not out or end > out[-1]):
            out.append(end)
    return [*out, len(data)] if data else []


def name_of(chunk: bytes) -> tuple[int, int]:
    """Two signed 64-bit halves of a 128-bit hash."""
    d = xxhash.xxh3_128_digest(chunk)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def chunk_names(docs: DataFrame, mask_bits: int = MASK_BITS) -> DataFrame:
    """h1, h2 of every chunk of every text."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_batches(batches, "text", BATCH_BYTES):
            names = []
            for text in batch.column("text").to_pylist():
                data, start = (text or "").encode(), 0
                for end in cuts(data, mask_bits):
                    names.append(name_of(data[start:end]))
                    start = end
            a = np.array(names, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["h1", "h2"])

    return docs.select("text").mapInArrow(name, "h1 long, h2 long")


def repeated_table(names: DataFrame, table_bits: int = TABLE_BITS) -> np.ndarray:
    """Bits of the names that occur more than once; 2**table_bits bits, however many names there are."""
    bit = F.col("h1").bitwiseAND(F.lit((1 << table_bits) - 1))
    words = (
        names.groupBy("h1", "h2").count().where("count > 1")
        .select(F.shiftright(bit, 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(h1 & 31 as int))").alias("bits"))
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ).toArrow()
    out = np.zeros(1 << (table_bits - 5), dtype=np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


class Codec:
    """What a task needs of a byte-level vocabulary."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        if not self.encoder.byte_level:
            raise ValueError(f"not a byte-level vocabulary: {path}")
        self.bytes = np.array(self.encoder.token_bytes(), dtype=object)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.kind = np.dtype("<u2" if len(self.bytes) <= 1 << 16 else "<u4")  # of ids on their way

    def encode(self, data: bytes) -> np.ndarray:
        return self.encoder.ids(data.decode())

    def pack(self, data: bytes) -> bytes:
        return self.encode(data).astype(self.kind).tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes[ids].tolist())

    def joined(self, parts: list[np.ndarray]) -> tuple[np.ndarray, bytes]:
        """Ids of the whole text from those of its parts, and its bytes."""
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        data = self.decode(ids)
        if len(parts) < 2:
            return ids, data
        ends = np.cumsum(self.lengths[ids])
        joins = ends[np.cumsum([len(p) for p in parts])[:-1] - 1]
        raw = np.frombuffer(data, dtype=np.uint8)
        before, after = raw[:-1], raw[1:]
        safe = np.flatnonzero((before > 32) & (before < 127) & ((after == 32) | (after == 10))) + 1
        safe = np.concatenate(([0], safe[np.isin(safe, ends)], [len(data)]))
        out, done = [], 0  # done: bytes that are final
        for join in joins.tolist():
            at = int(np.searchsorted(safe, join))
            if join < done or safe[at] == join:
                continue
            lo, hi = max(int(safe[at - 1]), done), int(safe[at])
            a, b = np.searchsorted(ends, [done, lo], side="right")
            out += [ids[a:b], self.encode(data[lo:hi])]
            done = hi
        out.append(ids[np.searchsorted(ends, done, side="right") :])
        return np.concatenate(out).astype(np.uint32), data

    def digest(self, parts: list[np.ndarray]) -> tuple[int, str, str]:
        ids, data = self.joined(parts)
        text = data.decode("utf-8", errors="replace").encode()
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def _parts(docs: DataFrame, tokenizer: str, table, mask_bits: int, table_bits: int) -> DataFrame:
    """Done documents (row null), and the parts of the others: ids, or the bytes and name of a repeated chunk."""
    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "row", "part", "ids", "h1", "h2", "chunk"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bits = codec(tokenizer), table.value
        row = TaskContext.get().partitionId() << 40
        for batch in even_batches(batches, "text", BATCH_BYTES):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data, parts, start, own = (text or "").encode(), [], 0, 0
                for end in cuts(data, mask_bits):
                    h1, h2 = name_of(data[start:end])
                    at = h1 & ((1 << table_bits) - 1)
                    if bits[at >> 5] >> (at & 31) & 1:
                        if own < start:
                            parts.append((code.pack(data[own:start]), None, None, None))
                        parts.append((None, h1, h2, data[start:end]))
                        own = end
                    start = end
                if parts:
                    if own < start:
                        parts.append((code.pack(data[own:start]), None, None, None))
                    out += [(doc_id, None, None, None, row, i, *part) for i, part in enumerate(parts)]
                    row += 1
                else:
                    out.append((doc_id, *code.digest([code.encode(data)]), *[None] * 6))
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(
        split,
        f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string, row long, part int, ids binary, h1 long, h2 long, chunk binary",
    )


def encode_decode(docs: DataFrame, tokenizer: str, mask_bits: int = MASK_BITS, table_bits: int = TABLE_BITS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of ``docs``."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(repeated_table(chunk_names(docs, mask_bits), table_bits))
    parts = written(_parts(docs, tokenizer, table, mask_bits, table_bits), "parts")

    @F.pandas_udf("binary")
    def encode(chunks: pd.Series) -> pd.Series:
        return chunks.map(codec(tokenizer).pack)

    key = docs.schema["doc_id"].dataType.simpleString()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer)
        for batch in batches:
            for i in range(batch.num_rows):
                own = sorted(batch.column("parts")[i].as_py(), key=lambda x: x["part"])
                n, ids, text = code.digest([np.frombuffer(x["ids"], code.kind) for x in own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, 1), pa.array([n]), pa.array([ids]), pa.array([text])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    repeated = parts.where("chunk is not null")
    once = repeated.groupBy("h1", "h2").agg(F.first("chunk").alias("chunk")).select("h1", "h2", encode("chunk").alias("ids"))
    # Written, so that the join has a shuffle of its own on either side, which can be split.
    once = written(once, "chunks")
    met = repeated.select("doc_id", "row", "part", "h1", "h2").join(once, ["h1", "h2"]).select("doc_id", "row", "part", "ids")
    own = parts.where("ids is not null").select("doc_id", "row", "part", "ids")
    whole = (
        met.unionByName(own).groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("part", "ids")).alias("parts"))
        .select("doc_id", "parts").mapInArrow(put_together, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    )
    return parts.where("row is null").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").unionByName(whole)
