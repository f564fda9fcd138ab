"""Quality rules on repetition inside a text, by a suffix array over its words.

Every text gets a suffix array over its words, by prefix doubling in which only suffixes that still share
their beginning with another one are sorted again. Neighbours in it give the longest common prefixes, whose
intervals are the repeated word sequences: an interval (length, occurrences) is a maximal repeat if its
occurrences can be extended neither to the right, by being an interval, nor to the left, by having
different words before them. The spans of all maximal repeats of at least ``MIN_REPEAT`` words
are united. A text is kept if they cover at most ``MAX_COVERED`` percent of its words and the longest repeat
has at most ``MAX_REPEAT`` words. Occurrences may overlap, so a run of one word repeats itself.

Before that come base rules: too few words, or too many of them in repeated five-word windows. A word is
in a repeated window if one of its suffixes nearby shares five words with a neighbour, so the same array
answers that.

Many texts share an array: a word is told apart by its text, so nothing is common to two texts. A
batch has about ``BATCH_BYTES``; a longer text is an array of its own and takes about 8 bytes a word for
each doubling of its longest repeat, and 150 bytes a word beside that.

Null and empty texts have no words, zeros everywhere, and fail the base rules. Rows are independent: ties
and repeated rows get equal results. Extra columns are kept, but for those named like results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.shared import text_or_empty
from pointlab.llm.tokencount import BATCH_BYTES, even_batches

WINDOW = 5
MIN_WORDS = 10
MAX_WINDOWS = 20  # percent of the words
MIN_REPEAT = 16
MAX_COVERED = 10  # percent of the words
MAX_REPEAT = 40
BLANK = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


class Repeats(NamedTuple):
    """Maximal repeats: number of words, and the first and last place of the suffixes that begin with them."""

    length: np.ndarray
    first: np.ndarray
    last: np.ndarray


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in an order that puts equal beginnings together, and the number of symbols that each
    shares with the one before it. The order of single symbols is that of their numbers; every text must end where
    its symbols end, as symbols of two texts differ."""
    n = len(symbols)
    order = np.argsort(symbols)
    levels = [_classes(symbols[order], order, n)]
    step = 1
    while True:
        own = levels[-1]
        held = np.bincount(own[:n], minlength=n)
        active = np.flatnonzero(held[own[:n]] > 1)
        if not len(active):
            break
        after = np.minimum(active + step, n)
        # Groups stay where they are; inside, suffixes that are over come first.
        key = own[active].astype(np.int64) * (n + 1) + (own[after].astype(np.int64) + 1) * (after < n)
        by = np.argsort(key)
        key, active = key[by], active[by]
        group = own[active]
        place = np.arange(len(key))
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        base = np.maximum.accumulate(np.where(new_group, place, 0))
        start = np.maximum.accumulate(np.where(new_key, place, 0))
        finer = own.copy()
        finer[active] = group + (start - base)
        levels.append(finer)
        step *= 2
    array = np.empty(n, np.int64)
    array[levels[-1][:n]] = np.arange(n)
    shared = np.zeros(n, np.int64)
    # Pairs that share a symbol, from the longest steps down.
    at = np.flatnonzero(levels[0][array[1:]] == levels[0][array[:-1]]) + 1
    left, right = array[at - 1].copy(), array[at].copy()
    common = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][left] == levels[k][right]
        same &= (left < n) & (right < n)
        width = same.astype(np.int64) << k
        left, right, common = left + width, right + width, common + width
    shared[at] = common
    return array, shared


def _classes(ordered: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Place of the first of its group for each symbol; one more for the end, of its own."""
    start = np.maximum.accumulate(np.where(np.concatenate(([True], ordered[1:] != ordered[:-1])), np.arange(n), 0))
    out = np.empty(n + 1, np.int32)
    out[order] = start
    out[n] = n
    return out


def maximal_repeats(symbols: np.ndarray, array: np.ndarray, shared: np.ndarray, least: int) -> Repeats:
    """Maximal repeats of at least ``least`` symbols."""
    out: list[tuple[int, int, int]] = []
    before = np.where(array > 0, symbols[array - 1], -1)
    # Suffixes that differ from the one above in what stands before them.
    turns = np.concatenate(([0], np.cumsum(before[1:] != before[:-1]))).tolist()

    def close(size: int, first: int, last: int) -> None:
        if turns[last] > turns[first]:
            out.append((size, first, last))

    open_: list[tuple[int, int]] = []  # lengths, first places
    last = -1
    # Intervals lie in stretches where neighbours share at least ``least`` symbols.
    places = np.flatnonzero(shared >= least)
    for at, size in zip(places.tolist() + [-1], shared[places].tolist() + [0]):
        if at != last + 1:
            while open_:
                close(*open_.pop(), last)
        first = at - 1
        while open_ and open_[-1][0] > size:
            longer, first = open_.pop()
            close(longer, first, last)
        if size and (not open_ or open_[-1][0] < size):
            open_.append((size, first))
        last = at
    return Repeats(*np.array(out, np.int64).reshape(-1, 3).T)


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a span."""
    turns = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(turns)[:n] > 0


def measure(texts: list[str], window: int, least: int) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest_repeat, n_repeats of each text."""
    index: dict[bytes, int] = defaultdict(count().__next__)
    words, sizes, rows = [], [], []
    for text in texts:
        own = np.fromiter(map(index.__getitem__, text.encode().split()), np.int64)
        words.append(own)
        sizes.append(len(own))
        lines = [x for x in text.split("\n") if x.strip(BLANK)]
        rows.append((len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))))
    n_words = np.array(sizes, np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    n = len(doc)
    out = {"n_words": n_words} | dict(zip(("word_chars", "n_symbols", "n_dup_lines"), np.array(rows, np.int64).reshape(-1, 3).T))
    per_text = lambda which: np.bincount(doc[which], minlength=len(texts)).astype(np.int64)
    if not n:
        zero = np.zeros(len(texts), np.int64)
        return out | dict.fromkeys(("n_repeat_words", "n_covered", "longest_repeat", "n_repeats"), zero)
    symbols = np.concatenate(words) + doc * max(len(index), 1)
    array, shared = suffix_array(symbols)
    longest = np.zeros(n, np.int64)  # words of the longest repeat that begins there
    longest[array] = np.maximum(shared, np.append(shared[1:], 0))
    windows, spans = np.flatnonzero(longest >= window), np.flatnonzero(longest >= least)
    found = maximal_repeats(symbols, array, shared, least)
    owner = doc[array[found.first]]
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, owner, found.length)
    return out | {
        "n_repeat_words": per_text(covered(windows, np.full(len(windows), window), n)),
        # The longest repeat from a word covers the shorter ones, and lies in a maximal one if it is none itself.
        "n_covered": per_text(covered(spans, longest[spans], n)),
        "longest_repeat": most,
        "n_repeats": np.bincount(owner, minlength=len(texts)).astype(np.int64),
    }


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "n_repeats")


def repetition(
    docs: DataFrame, *, window: int = WINDOW, min_words: int = MIN_WORDS, max_windows: int = MAX_WINDOWS,
    min_repeat: int = MIN_REPEAT, max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``docs`` with the measures, base_failed and kept."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_batches(batches, "__text", batch_bytes):
            found = measure(batch.column("__text").to_pylist(), window, min_repeat)
            own = [(c, f) for c, f in zip(batch.columns, batch.schema.names) if f != "__text"]
            yield pa.RecordBatch.from_arrays([*[c for c, _ in own], *[pa.array(found[x]) for x in RESULTS]], [*[f for _, f in own], *RESULTS])

    results = {*RESULTS, "base_failed", "kept", "__text"}
    rows = docs.select(*[c for c in docs.columns if c.lower() not in results], text_or_empty().alias("__text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "__text")
    measured = rows.mapInArrow(of, fields + ", ".join(f"{x} long" for x in RESULTS))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_windows * F.col("n_words"))
    passed = (100 * F.col("n_covered") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)


def _covered(name: str, m: int) -> str:
    """SQL for words in windows of m words that a text holds twice or more."""
    return f"""
{name}_w AS (SELECT r, i, array_to_string(ws[i : i + {m - 1}], ' ') AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - {m - 2})) AS i FROM t)),
{name}_f AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM {name}_w) WHERE n > 1),
{name} AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {m})) AS p FROM {name}_f) GROUP BY r)"""


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
{_covered("short", WINDOW)},
{_covered("long", MIN_REPEAT)},
{_covered("longest", MAX_REPEAT + 1)},
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
coalesce(lines.n, 0) AS n_dup_lines, coalesce(short.n, 0) AS n_repeat_words, coalesce(long.n, 0) AS n_covered, coalesce(longest.n, 0) AS n_beyond
FROM t LEFT JOIN lines USING (r) LEFT JOIN short USING (r) LEFT JOIN long USING (r) LEFT JOIN longest USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_WINDOWS} * n_words AS base_failed,
NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_WINDOWS} * n_words) AND 100 * n_covered <= {MAX_COVERED} * n_words AND n_beyond = 0 AS kept FROM m
"""
