"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of character sequences up to ``ORDER``: letters in lower case, everything
else one blank between words. Counts of the longest sequences are discounted and interpolated with
shorter ones, whose counts are numbers of different characters before them. Probabilities are kept in
arrays sorted by the hash of the sequence, one column for each language, with the weights of shorter
sequences beside them; a sequence that no language has seen is scored through its ending. A text gets
the language of the lowest cross-entropy per character. It is rejected if that exceeds what the
language's own texts reach: models are fitted on seven eighths of the sample, and the rest gives for
each language the mean, the deviation per character and the limit.

The models are fitted on a bounded sample of the labelled rows, about ``train_chars`` characters of
each language: texts, and of long ones blocks of ``SPREAD`` characters, are picked by a hash of id, text
and block, repeated rows once; all of them are used where there are no more than that. Every language
with a labelled text that has a letter has a model. Where an eighth held back would leave nothing to fit,
nothing is held back; a language without texts held back takes the widest limit of the others. Counting is done in Spark; the counts of the sample, whose size is bounded by it, come
to the driver, and the models are broadcast. Scoring reads whole texts in blocks, in one pass without a
shuffle.

Texts that are null or have no letter are ``und`` with score 0, and rejected; so is everything if no
row is labelled. Ties go to the language that is first in order. Extra columns are not read; repeated
rows are scored alike. Rows without doc_id, text or language are not learned from.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.shared import written
from pointlab.llm.tokencount import BATCH_BYTES, even_batches

ORDER = 4
TRAIN_CHARS = 1_500_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BLANK = 32
BLOCK = 1 << 17
SPREAD = 20_000  # characters of a block of the sample
SLACK = 1.75  # of the highest cross-entropy among calibration texts
DEVIATIONS = 4
NAMES = ("lang_pred", "score", "cross_entropy", "rejected")


@functools.cache
def _folded() -> np.ndarray:
    """Code of each character: that of its lower case if it is a letter, a blank otherwise."""
    out = np.full(0x110000, BLANK, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            out[c] = ord(s.lower()[0])
    return out


def codes(text: str) -> np.ndarray:
    """Codes of a text, with one blank after each word and none before the first."""
    raw = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    raw = np.append(raw, np.uint32(BLANK))
    kept = raw != BLANK
    kept[1:] |= kept[:-1]
    return raw[kept]


def grams(padded: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the sequences of ``order`` codes that end at each position from ORDER - 1 on."""
    n = len(padded) - ORDER + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(ORDER - order, ORDER):
        h = h * FACTOR + padded[i : i + n].astype(np.uint64) + np.uint64(1)
    return h


PAD = np.full(ORDER - 1, BLANK, dtype=np.uint32)


@dataclass
class Models:
    languages: list[str]
    keys: list[np.ndarray]  # of each order, sorted
    log_p: list[np.ndarray]  # a row for each key, a column for each language
    contexts: list[np.ndarray]
    log_weight: list[np.ndarray]
    floor: float  # log probability of a character never seen
    mean: np.ndarray
    deviation: np.ndarray
    limit: np.ndarray

    def log_probabilities(self, padded: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of each position from ORDER - 1 on, in each language."""
        return self._log_p(padded, np.arange(len(padded) - ORDER + 1), order)

    def _log_p(self, padded: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        if not order:
            return np.full((len(at), len(self.languages)), self.floor, dtype=np.float32)
        h, context = np.zeros(len(at), dtype=np.uint64), None
        for i in range(ORDER - order, ORDER):
            context, h = h, h * FACTOR + padded[at + i].astype(np.uint64) + np.uint64(1)
        keys = self.keys[order - 1]
        found = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        out = self.log_p[order - 1][found]
        if len(missing := np.flatnonzero(keys[found] != h)):
            c = self.contexts[order - 1]
            place = np.minimum(np.searchsorted(c, context[missing]), len(c) - 1)
            weight = np.where((c[place] == context[missing])[:, None], self.log_weight[order - 1][place], 0)
            out[missing] = weight + self._log_p(padded, at[missing], order - 1)
        return out

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of each text, and its cross-entropy per character in each language."""
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        held: list[np.ndarray] = []
        owners: list[int] = []

        def flush() -> None:
            if not held:
                return
            padded = np.concatenate([x for own in held for x in (PAD, own)])
            log_p = self.log_probabilities(padded)
            start = 0
            for i, own in zip(owners, held, strict=True):
                # Positions of the padding before the next text are skipped.
                sums[i] -= log_p[start : start + len(own)].sum(axis=0, dtype=np.float64)
                start += len(own) + len(PAD)
            held.clear()
            owners.clear()

        size = 0
        for i, text in enumerate(texts):
            own = codes(text or "")
            counts[i] = len(own)
            if len(own) > BLOCK:
                whole = np.concatenate((PAD, own))
                for a in range(0, len(own), BLOCK):
                    sums[i] -= self.log_probabilities(whole[a : a + BLOCK + len(PAD)]).sum(axis=0, dtype=np.float64)
            elif len(own):
                held.append(own)
                owners.append(i)
                size += len(own)
                if size >= BLOCK:
                    flush()
                    size = 0
        flush()
        return counts, sums / np.maximum(counts, 1)[:, None]


def fit(languages: list[str], counted: pa.Table) -> Models | None:
    """From the counts (lang, size, gram, context, ending, n) of all sequences up to ORDER."""
    if not languages or not counted.num_rows:
        return None
    index = {name: i for i, name in enumerate(languages)}
    lang = np.array([index[x] for x in counted["lang"].to_pylist()])
    size, n = counted["size"].to_numpy(), counted["n"].to_numpy().astype(np.float64)
    gram, context, ending = (counted[c].to_numpy().view(np.uint64) for c in ("gram", "context", "ending"))
    wide = len(languages)
    characters = len(np.unique(gram[size == 1])) + 1
    below = np.full((1, wide), 1.0 / characters)
    below_keys = np.zeros(1, dtype=np.uint64)
    models = Models(languages, [], [], [], [], -float(np.log(characters)), *(np.zeros(wide) for _ in range(3)))
    for k in range(1, ORDER + 1):
        own = size == k
        keys, first, place = np.unique(gram[own], return_index=True, return_inverse=True)
        count = np.zeros((len(keys), wide))
        if k == ORDER:
            count[place, lang[own]] = n[own]
        else:  # different characters before it
            longer = size == k + 1
            np.add.at(count, (np.searchsorted(keys, ending[longer]), lang[longer]), 1)
        before, at = np.unique(context[own][first], return_inverse=True)
        total, kinds = np.zeros((len(before), wide)), np.zeros((len(before), wide))
        np.add.at(total, at, count)
        np.add.at(kinds, at, count > 0)
        ones, twos = (count == 1).sum(axis=0), (count == 2).sum(axis=0)
        discount = np.where(ones + 2 * twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5).clip(0.1, 0.9)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        shorter = below[np.searchsorted(below_keys, ending[own][first])] if k > 1 else below
        seen = np.where(total[at] > 0, np.maximum(count - discount, 0) / np.maximum(total[at], 1), 0.0)
        p = seen + weight[at] * shorter
        models.keys.append(keys)
        models.log_p.append(np.log(p).astype(np.float32))
        models.contexts.append(before)
        models.log_weight.append(np.log(weight).astype(np.float32))
        below, below_keys = p, keys
    return models


def count_grams(sample: DataFrame) -> DataFrame:
    """lang, size, gram, context, ending, n of all sequences in the sample (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_batches(batches, "text", BATCH_BYTES):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for name in dict.fromkeys(langs.tolist()):
                own = [codes(texts[i]) for i in np.flatnonzero(langs == name)]
                padded = np.concatenate([x for c in own for x in (PAD, c)])
                real = np.concatenate([x for c in own for x in (np.ones(len(c), bool), np.zeros(len(PAD), bool))])[: len(padded) - len(PAD)]
                for k in range(1, ORDER + 1):
                    h = grams(padded, k)[real]
                    keys, first, n = np.unique(h, return_index=True, return_counts=True)
                    last = padded[len(PAD) :][real][first].astype(np.uint64)
                    context = (keys - last - np.uint64(1)) * np.uint64(pow(int(FACTOR), -1, 1 << 64))
                    ending = grams(padded, k - 1)[real][first] if k > 1 else np.zeros(len(keys), np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys)), pa.array(np.full(len(keys), k, np.int32)), *(pa.array(x.view(np.int64)) for x in (keys, context, ending)), pa.array(n)],
                        ["lang", "size", "gram", "context", "ending", "n"],
                    )

    parts = sample.mapInArrow(count, "lang string, size int, gram long, context long, ending long, n long")
    return parts.groupBy("lang", "size", "gram", "context", "ending").agg(F.sum("n").alias("n"))


def sample_of(docs: DataFrame, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """lang, doc_id, text of about ``train_chars`` characters of each language, at least one text of each."""
    labelled = docs.where("doc_id is not null and text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
    labelled = labelled.select("lang", "doc_id", "text", F.xxhash64("text").alias("own"), F.char_length("text").alias("chars"))
    # Repeated rows count once. A map with one entry for each language.
    once = labelled.groupBy("lang", "doc_id", "own").agg(F.max("chars").alias("chars"))
    sizes = once.groupBy("lang").agg(F.sum("chars").alias("chars")).select(F.map_from_entries(F.collect_list(F.struct("lang", "chars"))))
    total = F.try_element_at(sizes.scalar(), F.col("lang"))
    pick = lambda block: F.pmod(F.xxhash64(F.lit(11), "doc_id", "own", block), F.lit(1 << 30)) / F.lit(float(1 << 30))
    blocks = F.sequence(F.lit(0), F.floor((F.col("chars") - 1) / SPREAD).cast("int"))
    taken = labelled.withColumn("total", total).withColumn("blocks", F.filter(blocks, lambda b: pick(b) * F.col("total") < train_chars))
    parts = taken.select("lang", "doc_id", "own", "text", F.explode("blocks").alias("block"))
    parts = parts.select("lang", "doc_id", "own", "block", F.substring("text", F.col("block") * SPREAD + 1, F.lit(SPREAD)).alias("text"))
    sample = written(parts.where(F.col("text").rlike(r"\p{L}")).dropDuplicates(["lang", "doc_id", "own", "block"]).select("lang", "doc_id", "text"), "sample")
    # A language whose letters lie in few blocks may have none; its first text is then taken whole. Their names are a
    # few at most, and mostly none; texts are looked through again, not shuffled.
    missing = [r.lang for r in once.select("lang").distinct().join(sample.select("lang").distinct(), "lang", "left_anti").collect()]
    if not missing:
        return sample
    first = labelled.where(F.col("lang").isin(missing)).groupBy("lang").agg(F.min(F.struct(pick(F.lit(0)).alias("at"), "doc_id", "text")).alias("first"))
    return written(sample.union(first.select("lang", "first.doc_id", "first.text")), "sample")


def train(docs: DataFrame, train_chars: int = TRAIN_CHARS) -> Models | None:
    """Models from the labelled rows of ``docs`` (doc_id, text, lang)."""
    sample = sample_of(docs, train_chars)
    back = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(8)) == 0
    # Languages of which nothing would be left to fit.
    lone = [r.lang for r in sample.groupBy("lang").agg(F.every(back).alias("all")).where("all").collect()]
    held_back = back & ~F.col("lang").isin(lone)
    counted = count_grams(sample.where(~held_back)).toArrow()
    languages = sorted(set(counted["lang"].to_pylist()))
    models = fit(languages, counted)
    if models is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        index = {name: i for i, name in enumerate(own.languages)}
        for batch in even_batches(batches, "text", BATCH_BYTES):
            n, h = own.cross_entropies(batch.column("text").to_pylist())
            at = np.array([index.get(x, -1) for x in batch.column("lang").to_pylist()])
            ok = (n > 0) & (at >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[ok], pa.int32()), pa.array(n[ok]), pa.array(h[np.arange(len(at)), at][ok])], ["lang", "n", "h"]
            )

    measured = sample.where(held_back).mapInArrow(measure, "lang int, n long, h double").toArrow()
    at, n, h = (measured[c].to_numpy() for c in ("lang", "n", "h"))
    models.limit[:] = np.inf
    for i in range(len(languages)):
        own_n, own_h = n[at == i], h[at == i]
        if len(own_n):
            models.mean[i] = np.average(own_h, weights=own_n)
            models.deviation[i] = np.sqrt(np.average(own_n * (own_h - models.mean[i]) ** 2))
            models.limit[i] = SLACK * np.max(own_h - DEVIATIONS * models.deviation[i] / np.sqrt(own_n)).clip(models.mean[i])
    # Without texts held back, the widest of the other languages.
    if len(own := np.unique(at)):
        rest = np.setdiff1d(np.arange(len(languages)), own)
        for values in (models.mean, models.deviation, models.limit):
            values[rest] = values[own].max()
    return models


def identify(docs: DataFrame, models: Models | None, names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy and rejected, or other names (columns so named are replaced).

    The score is the share of the best language if languages weigh exp(-cross-entropy)."""
    new = list(names)
    kept = docs.select(*[c for c in docs.columns if c.lower() not in new])
    if models is None:
        none = (F.lit("und"), F.lit(0.0), F.lit(None).cast("double"), F.lit(True))
        return kept.select("*", *[value.alias(name) for value, name in zip(none, new, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = np.array(own.languages, dtype=object)
        for batch in even_batches(batches, "text", BATCH_BYTES):
            n, h = own.cross_entropies(batch.column("text").to_pylist())
            best = np.argmin(h, axis=1)
            low = h[np.arange(len(best)), best]
            ok = n > 0
            share = np.where(ok, 1 / np.exp(low[:, None] - h).sum(axis=1), 0.0)
            rejected = ~ok | (low > own.limit[best] + DEVIATIONS * own.deviation[best] / np.sqrt(np.maximum(n, 1)))
            pred = np.where(ok, languages[best], "und")
            columns = [pa.array(pred, pa.string()), pa.array(share), pa.array(low, mask=~ok), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *new])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    kinds = zip(new, ("string", "double", "double", "boolean"), strict=True)
    return kept.mapInArrow(score, fields + "".join(f", `{name}` {kind}" for name, kind in kinds))
