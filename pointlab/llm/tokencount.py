"""Token counts of whole texts.

Texts are encoded in Arrow functions that return lengths only. Each task regroups its rows into
batches of about equal bytes, whatever the number of rows, so that memory does not follow the text
lengths. Texts longer than a batch are split at safe boundaries, where a visible ASCII character is
followed by a blank or a new line, and their counts are added up; a byte-level vocabulary has no
token across such a place. Vocabularies of other kinds are given whole texts.

Null texts count as empty: 0 bytes, 0 tokens. Rows are independent, so repeated rows, ties and extra
columns make no difference; the result has doc_id, n_bytes, n_tokens, over_limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.encoder import encoder, pieces

LIMIT = 512
BATCH_BYTES = 1 << 20


def even_batches(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of ``column``; a longer row is a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for each row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in even_batches(batches, "text", batch_bytes):
            counts = [
                sum(map(enc.count, pieces(text, batch_bytes))) if enc.byte_level else enc.count(text)
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, f"doc_id {key}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
