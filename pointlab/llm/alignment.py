"""Alignment of the tokens of two vocabularies by tokenizer spans.

A text, with a space before it, is encoded by a byte-level vocabulary (A) and by a sentencepiece
vocabulary (B). Places where tokens of both end cut the text into groups; every A token of a group is
linked to every B token of it. A pair of ids counts the documents that hold it linked.

The spans that the two libraries give are the cuts: character offsets of A, which become byte offsets, and
spans of B. A token whose span is not as long as its decoded bytes, as for parts of a character and
for byte-fallback pieces, ends where the decoded bytes end. In plain ASCII the span of a token is its
length, so the ids are enough there.

Neither vocabulary has a token across the place before a single space or new line between two visible
characters (B is looked through for such pieces), so a text may be cut there. Each different piece of a block
of texts is encoded once. A text of which a piece does not decode to itself is tried again as a whole; if it does not
decode to itself either, it has no tokens.

Texts are worked through in blocks of about ``BLOCK_BYTES``; a block lists its different pairs once, with
the number of its documents for each. Only these lists meet the counts of the corpus, one row for each
pair, and go back to their block; a pair that all documents hold is a row a block. A text needs about
150 times its bytes in memory while its block is worked on.

Null and empty texts have no tokens: zeros, and '' for the hash. Every row is a document of its own,
also if it repeats another one or has no doc_id. Extra columns are not read. The result has doc_id, n_a,
n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.encoder import LONG_RUN, encoder
from pointlab.llm.shared import text_or_empty, written
from pointlab.llm.tokencount import even_batches

BLOCK_BYTES = 12 << 20
CUT = re.compile(r"(?<=[!-~\w])(?=[ \n][!-~\w])")
# A text without these and of printable characters is cut at every space and new line in it.
TWO_BLANKS = ("  ", " \n", "\n ", "\n\n")
VISIBLE = re.compile(r"[!-~\w]")
TOGETHER = 4000  # pieces encoded in one call
LEAD = " a"  # before pieces that begin with a new line
SPACE = "▁"


class Tokens(NamedTuple):
    """Ids of the tokens of a text and the byte offsets of their ends."""

    ids: np.ndarray
    ends: np.ndarray


class Aligned(NamedTuple):
    """For each piece: its groups as text, numbers of A tokens, B tokens, groups and links, and where its links
    begin in ``pairs``."""

    groups: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    first: np.ndarray
    pairs: np.ndarray

    @staticmethod
    def joined(parts: list[Aligned], order: np.ndarray) -> Aligned:
        """The pieces of all parts, in another order; each piece has its place in ``order``."""
        held = np.array([len(p.pairs) for p in parts])
        at = np.argsort(order)
        numbers = [np.concatenate(x)[at] for x in list(zip(*parts))[1:5]]
        first = np.concatenate([p.first + before for p, before in zip(parts, np.cumsum(held) - held)])[at]
        groups = [x for p in parts for x in p.groups]
        return Aligned(list(map(groups.__getitem__, at.tolist())), *numbers, first, np.concatenate([p.pairs for p in parts]))


NOTHING = Aligned([""], *[np.zeros(1, np.int64)] * 5, np.zeros(0, np.int64))


def refined(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte offsets of token ends: those of the spans, or of the decoded bytes where a span has another length."""
    decoded = np.cumsum(sizes[ids])
    return np.where(ends - begins == sizes[ids], ends, decoded)


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all entries of the ranges that begin at ``first``."""
    start = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(start - first, sizes)


def is_plain(text: str) -> bool:
    ends = text[:1] + text[-1:]
    return bool(text) and " " not in ends and "\n" not in ends and text.replace("\n", " ").isprintable() and not any(x in text for x in TWO_BLANKS)


def pairs_of(spans: list[tuple[int, int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(spans), np.int64, 2 * len(spans)).reshape(-1, 2)


class Aligner:
    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(a)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        own = encoder(a)
        self.fast = own.fast
        self.bytes_a = own.token_bytes()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes_b = [
            bytes([int(x[3:5], 16)]) if self.pieces.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)
        ]
        self.sizes_a, self.sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        # Ids as text, followed by each of the separators.
        wide = max(len(self.bytes_a), len(self.bytes_b))
        self.wide, self.text = wide, [f"{i}{end}" for end in (",", "|", ";", "") for i in range(wide)]
        # A piece with a space or a new line behind something else would lie across a cut.
        self.cuts = own.byte_level and not any(re.search(f"[^{SPACE}]{SPACE}|\n", x) for x in names)

    def split(self, text: str) -> list[str]:
        """Pieces of a space and ``text``; the space before a word goes without saying."""
        pieces = CUT.split(" " + text) if self.cuts else [" " + text]
        return [x[1:] if len(x) > 1 and x[0] == " " and VISIBLE.match(x[1]) else x for x in pieces]

    def numbered(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different pieces, the piece numbers of all texts one after the other, and how many each text has."""
        plain = [self.cuts and is_plain(t) for t in texts]
        lists = pc.split_pattern(pc.replace_substring(pa.array([t if own else None for t, own in zip(texts, plain)], pa.large_string()), "\n", " \n"), " ")
        other = pa.array([self.split(t) if t and not own else None for t, own in zip(texts, plain)], pa.large_list(pa.large_string()))
        sizes = [pc.fill_null(pc.list_value_length(x), 0).to_numpy() for x in (lists, other)]
        coded = pa.concat_arrays([pc.list_flatten(x).cast(pa.large_string()) for x in (lists, other)]).dictionary_encode()
        numbers = coded.indices.to_numpy().astype(np.int64)
        # Every text has pieces in one of the two.
        first = [np.cumsum(n) - n for n in sizes]
        starts = np.where(sizes[0] > 0, first[0], first[1] + sizes[0].sum())
        held = sizes[0] + sizes[1]
        return coded.dictionary.to_pylist(), numbers[_spread(starts, held)], held

    def tokens(self, text: str, data: bytes) -> tuple[Tokens, Tokens] | None:
        """A and B of a text that begins with a space, ``data`` as bytes; None if one does not decode to that."""
        if text.isascii() and self.fast is not None and not LONG_RUN.search(text):
            a = self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            ends_a = np.cumsum(self.sizes_a[a])
            b = self.pieces.encode_as_numpy(text[1:]).astype(np.int64)
            ends_b = np.cumsum(self.sizes_b[b])
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False)
            a = np.array(found.ids, np.int64)
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            at = np.concatenate(([0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))))  # byte offset of each character
            spans = at[pairs_of(found.offsets)]
            ends_a = refined(a, spans[:, 0], spans[:, 1], self.sizes_a)
            other = self.pieces.encode_as_offset_mapping(text[1:])
            b = np.array(other["ids"], np.int64)
            spans = pairs_of(other["offsets"]) + 1
            spans[0, 0] -= 1  # the space before the text
            spans = at[spans]
            ends_b = refined(b, spans[:, 0], spans[:, 1], self.sizes_b)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != data or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != data:
            return None
        return Tokens(a, ends_a), Tokens(b, ends_b)

    def together(self, pieces: list[str]) -> Iterator[list[int]]:
        """Numbers of pieces that may be put together: plain ones with plain ones, as both ends are visible."""
        groups: dict[bool, list[int]] = {True: [], False: []}
        for i, piece in enumerate(pieces):
            last = piece[-1]
            if not self.cuts or piece[0] == " " or len(piece) > 1000 or last == " " or not last.isprintable():
                yield [i]
                continue
            group = groups[piece.isascii()]
            group.append(i)
            if len(group) == TOGETHER:
                yield group.copy()
                group.clear()
        yield from filter(None, groups.values())

    def align(self, pieces: list[str]) -> tuple[Aligned, set[int]]:
        """All pieces, and the numbers of those that do not decode to themselves."""
        parts, order, bad = [], [], set()
        todo = list(self.together(pieces))
        while todo:
            some = todo.pop()
            own = self._aligned([pieces[i] for i in some])
            if own is None and len(some) > 1:
                todo += [some[: len(some) // 2], some[len(some) // 2 :]]
                continue
            if own is None:
                bad.add(some[0])
            parts.append(own or NOTHING)
            order += some
        return Aligned.joined(parts or [NOTHING], np.array(order or [0])), bad

    def _aligned(self, pieces: list[str]) -> Aligned | None:
        led = [x if x[0] in " \n" else " " + x for x in pieces]
        lead = led[0][0] != " "
        if lead:
            led.insert(0, LEAD)
        text = "".join(led)
        data = text.encode()
        found = self.tokens(text, data)
        if found is None:
            return None
        (a, ends_a), (b, ends_b) = found
        sizes = map(len, led) if len(data) == len(text) else (len(x.encode()) for x in led)
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(led)))
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if len(np.intersect1d(ends, common, assume_unique=True)) < len(ends):
            return None
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        piece_of = np.searchsorted(ends, common)
        number = lambda x: np.bincount(x, minlength=len(led))
        of_a, of_b = piece_of[group_a], piece_of[group_b]
        n_a, n_b = number(of_a), number(of_b)
        first_a, first_b = (np.concatenate(([0], np.cumsum(np.bincount(g, minlength=len(common))))) for g in (group_a, group_b))
        times = np.diff(first_b)[group_a]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pairs = np.repeat(a, times) << 32 | b[np.repeat(first_b[group_a], times) + within]
        n_links = number(np.repeat(of_a, times))
        # A tokens of a group, then its B tokens; what follows each is a comma, a bar, a semicolon or the end of a piece.
        flat = np.empty(len(a) + len(b), np.int64)
        flat[np.arange(len(a)) + first_b[group_a]] = a + np.where(np.append(group_a[1:] != group_a[:-1], True), self.wide, 0)
        last = np.append(group_b[1:] != group_b[:-1], True).astype(np.int64) + np.append(of_b[1:] != of_b[:-1], True)
        flat[np.arange(len(b)) + first_a[group_b + 1]] = b + np.where(last, (last + 1) * self.wide, 0)
        texts = list(map(self.text.__getitem__, flat.tolist()))
        cuts = [0, *np.cumsum(n_a + n_b).tolist()]
        groups = ["".join(texts[i:j]) for i, j in zip(cuts, cuts[1:])]
        found = Aligned(groups, n_a, n_b, number(piece_of), n_links, np.cumsum(n_links) - n_links, pairs)
        return Aligned(*[x[1:] for x in found[:-1]], pairs) if lead else found

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, Aligned]:
        """Numbers of the pieces of all texts, how many each has, and the pieces."""
        pieces, numbers, sizes = self.numbered(texts)
        found, bad = self.align(pieces)
        if not bad:
            return numbers, sizes, found
        # The whole text decides: it is one piece, or there is none.
        wholes, each = [found], np.split(numbers, np.cumsum(sizes)[:-1])
        for i in [i for i, own in enumerate(each) if not bad.isdisjoint(own.tolist())]:
            again = self._aligned([" " + texts[i]]) if sizes[i] > 1 else None
            each[i] = np.zeros(0, np.int64)
            if again is not None:
                each[i] = np.array([len(found.groups) + len(wholes) - 1])
                wholes.append(again)
        joined = Aligned.joined(wholes, np.arange(len(found.groups) + len(wholes) - 1))
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each)), joined


@functools.cache
def aligner(a: str, b: str) -> Aligner:
    """One per worker process."""
    return Aligner(a, b)


def block_rows(own: Aligner, ids: pa.Array, texts: list[str], block: int) -> tuple[dict, dict]:
    """Columns of the documents of a block, and of its list of pairs."""
    flat, sizes, pieces = own.block(texts)
    doc = np.repeat(np.arange(len(texts)), sizes)
    total = lambda per_piece: np.bincount(doc, weights=per_piece[flat], minlength=len(texts)).astype(np.int64)
    cuts, numbers = [0, *np.cumsum(sizes).tolist()], flat.tolist()
    hashes = [
        hashlib.sha256(";".join(map(pieces.groups.__getitem__, numbers[i:j])).encode()).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:])
    ]
    # Pieces of a document, then pairs of a document, with how often each occurs in it.
    wide = max(len(pieces.groups), 1)
    once, often = np.unique(doc * wide + flat, return_counts=True)
    pairs, local = np.unique(pieces.pairs, return_inverse=True)
    repeat = pieces.n_links[once % wide]
    where = _spread(pieces.first[once % wide], repeat)
    wide_pairs = max(len(pairs), 1)
    keys, at = np.unique(np.repeat(once // wide, repeat) * wide_pairs + local[where], return_inverse=True)
    times = np.bincount(at, weights=np.repeat(often, repeat), minlength=len(keys)).astype(np.int32)
    owner, pair = keys // wide_pairs, keys % wide_pairs
    held = np.bincount(owner, minlength=len(texts))
    starts = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
    steps = np.diff(pair, prepend=0)  # small numbers take little room
    steps[starts[:-1][held > 0]] = pair[starts[:-1][held > 0]]
    listed = lambda x: pa.ListArray.from_arrays(starts, pa.array(x.astype(np.int32)))
    docs = {
        "doc_id": ids, "n_a": total(pieces.n_a), "n_b": total(pieces.n_b), "n_groups": total(pieces.n_groups),
        "n_links": total(pieces.n_links), "groups_sha256": hashes, "steps": listed(steps), "times": listed(times),
    }
    in_docs = np.bincount(pair, minlength=len(pairs))
    return docs, {"block": np.full(len(pairs), block), "at": np.arange(len(pairs), dtype=np.int32), "pair": pairs, "docs": in_docs.astype(np.int32)}


def blocks(docs: DataFrame, a: str, b: str, block_bytes: int) -> DataFrame:
    """Rows of documents (pair is null) and of the lists of pairs of their blocks (pair is set)."""
    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "times", "at", "pair", "docs"]
    kinds = ["long", key, *["long"] * 4, "string", "array<int>", "array<int>", "int", "long", "int"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, schema = aligner(a, b), TaskContext.get().partitionId() << 32, None

        def full(columns: dict, rows: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema
            )

        gc.freeze()
        gc.disable()  # millions of small objects without cycles
        for number, (ids, texts) in enumerate(_joined(batches, block_bytes)):
            if schema is None:
                types = [pa.int64(), ids.type, *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 2, pa.int32(), pa.int64(), pa.int32()]
                schema = pa.schema(list(zip(names, types)))
            rows, pairs = block_rows(own, ids, texts, first + number)
            yield full(rows | {"block": np.full(len(texts), first + number)}, len(texts))
            for i in range(0, len(pairs["pair"]), 1 << 17):
                part = {k: v[i : i + (1 << 17)] for k, v in pairs.items()}
                yield full(part, len(part["pair"]))

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(of, ", ".join(map(" ".join, zip(names, kinds))))


def _joined(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """ids and texts of about ``most`` bytes."""
    ids, texts, held = [], [], 0
    for batch in even_batches(batches, "text", most):
        own = batch.column("text").to_pylist()
        size = batch.column("text").nbytes
        if texts and held + size > most:
            yield pa.concat_arrays(ids), texts
            ids, texts, held = [], [], 0
        ids.append(batch.column("doc_id"))
        texts += own
        held += size
    if texts:
        yield pa.concat_arrays(ids), texts


def alignments(docs: DataFrame, a: str, b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of ``docs``."""
    found = written(blocks(docs, a, b, block_bytes), "aligned")
    rows, lists = found.where("pair is null").drop("at", "pair", "docs"), found.where("pair is not null")
    counts = written(lists.groupBy("pair").agg(F.sum("docs").alias("count")), "pairs")
    # One row for each id of A, which a vocabulary bounds.
    highest = counts.groupBy(F.shiftright("pair", 32).alias("id")).agg(F.max("count").alias("most"))
    known = counts.join(highest, F.shiftright("pair", 32) == F.col("id")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = lists.select(F.col("block").alias("of"), "at", "pair").join(known, "pair").select("of", "at", "count", "best")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        counts, best = (np.zeros(right.num_rows, np.int64) for _ in range(2))
        at = right["at"].to_numpy()
        counts[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy()
        steps, times = (left[c].combine_chunks() for c in ("steps", "times"))
        held = steps.value_lengths().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(left.num_rows), held)
        walked = np.cumsum(steps.flatten().to_numpy().astype(np.int64))
        starts = np.cumsum(held) - held
        before = np.concatenate(([0], walked))[starts]
        pair, n = walked - np.repeat(before, held), times.flatten().to_numpy().astype(np.int64)

        def total(values):
            sums = np.concatenate(([0], np.cumsum(values[pair] * n)))
            return pa.array(sums[starts + held] - sums[starts])

        return pa.table({**{c: left[c] for c in kept}, "n_best": total(best), "count_sum": total(counts), "groups_sha256": left["groups_sha256"]})

    fields = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, f"{fields}n_best long, count_sum long, groups_sha256 string")
