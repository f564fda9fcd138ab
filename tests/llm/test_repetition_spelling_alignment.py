from __future__ import annotations

import random
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pointlab.llm import alignment, queries, repetition, spelling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n\n", "a", " a", "a ", "  two  blanks ", "it's we'll THEY'RE", "tab\there\r\nand\x0bthere\x0c", "x" * 3000, " " * 3000,
    "end<|endoftext|>of <|endoftext|> text <s> </s> <unk>", "é" * 1500, "naïve façade – “quotes” … 日本語 текст العربية 😀👍🏽", "1234567890 12.5%", "a b c　d\u0085e",
    "́combining  ́ again", "𝔘𝔫𝔦", "word " * 150, "ẞİı ÀÉÿ×÷", "." * 3000 + " end", "with ▁ inside and ▁word", "▁", "<0x41> <0xE6>", "a​b ﻿c", "nul\x00nul",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(ODD)]
    rows += [(100, "same row here again", "en", "s0", 13)] * 3 + [(None, "no id one two", "en", "s0", 13), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("n_words", "kept", "word", "n", "node", "block", "pair", "at", "n_a", "id", "edges", "steps", "after"):
        docs = docs.withColumn(name, F.lit("clash"))
    return rows, docs


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# Repetition


def test_suffix_array_shares_what_texts_share():
    rng = random.Random(3)
    for n in (1, 2, 7, 60, 300):
        symbols = np.array([rng.randrange(3) for _ in range(n)])
        array, shared = repetition.suffix_array(symbols)
        assert sorted(array) == list(range(n)) and shared[0] == 0
        suffixes = [tuple(symbols[i:]) for i in array.tolist()]
        assert suffixes == sorted(suffixes)
        for a, b, k in zip(suffixes, suffixes[1:], shared[1:].tolist()):
            assert a[:k] == b[:k] and a[k : k + 1] != b[k : k + 1]


def test_repetition_against_brute_force(spark, odd, none):
    rng = random.Random(5)
    rows, docs = odd
    texts = [t for _, t, *_ in rows]
    for _ in range(60):
        words = [rng.choice("abcdefgh") * rng.choice([1, 2]) for _ in range(rng.randrange(5, 120))]
        at = rng.randrange(len(words))
        texts.append(" ".join(words + words[at : at + rng.randrange(20)]) + rng.choice(["", "\nab\n ab\nab\n"]))
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for batch_bytes in (1, 300, 1 << 20):
        out = repetition.repetition(made, min_repeat=4, max_covered=30, max_repeat=9, batch_bytes=batch_bytes)
        got = {r.doc_id: tuple(r)[2:] for r in out.collect()}
        assert got == {i: brute.repetition(t, 4, 30, 9) for i, t in enumerate(texts)}
    out = repetition.repetition(docs)
    assert out.count() == len(rows) and {r.node for r in out.collect()} == {"clash"} and out.columns.count("kept") == 1
    assert repetition.repetition(none).count() == 0


def test_long_texts_and_thresholds(spark):
    one, long = "word " * 300_000, " ".join(f"w{i * i % 999_983}" for i in range(400_000))  # over a batch each
    clean, again = [f"c{i}" for i in range(1000)], [f"r{i}" for i in range(60)]
    texts = [one, long, " ".join(clean), " ".join(clean + again + ["x"] + again), " ".join(clean + again[:30] + ["x"] + again[:30])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repetition.repetition(rows).collect()}
    assert got[0].longest_repeat == 299_999 and got[0].n_covered == got[0].n_words == 300_000 and got[0].base_failed
    assert got[1].n_words == 400_000 and got[1].n_repeat_words == brute_windows(texts[1], 5)
    assert got[2].kept and got[3].longest_repeat == 60 and not got[3].kept and not got[3].base_failed and got[4].kept and got[4].n_covered == 60


def brute_windows(text, m):
    words = text.split()
    n = Counter(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return len({i + k for i in range(len(words) - m + 1) if n[tuple(words[i : i + m])] > 1 for k in range(m)})


def test_repetition_equals_its_sql(spark, odd):
    rows, docs = odd
    con = duckdb.connect()
    own = docs.select("doc_id", "text").toPandas()
    con.register("documents", own)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "base_failed", "kept"]
    expected = Counter(con.sql(repetition.ORACLE).select(*names).fetchall())
    assert Counter(tuple(r) for r in repetition.repetition(docs).select(*names).collect()) == expected


# Spelling variants


def random_words(rng, n):
    out = set()
    while len(out) < n:
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 9)))
        out.add(word)
        if rng.random() < 0.5:
            at = rng.randrange(len(word))
            out.add(word[:at] + rng.choice(["", "a", "ÿ" + word[at]]) + word[at + 1 :])
    return sorted(out - {""})


def test_neighbours_against_brute_force(spark):
    rng = random.Random(7)
    words = random_words(rng, 400) + ["a" * k for k in (12, 13, 3000, 3001)] + ["a" * 1500 + "b" + "a" * 1500, "b" + "a" * 2999]
    counts = {w: rng.randrange(1, 2000) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [(r.word, r.other, r.n, r.other_n) for r in spelling.neighbours(table).collect()]

    def cut(w):
        return {w[:i] + w[i + 1 :] for i in range(len(w))}

    cuts = {w: cut(w) if len(w) < 100 else set() for w in counts}
    expected = set()
    for a in counts:
        for b in counts:
            if a != b and max(len(a), len(b)) < 100 and (a in cuts[b] or b in cuts[a] or (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)):
                expected.add((a, b))
    long = {w: k for k, w in enumerate(words[-4:])}
    pairs = {(0, 1), (0, 2), (0, 3), (1, 2)}  # of the four long words
    expected |= {(a, b) for a in long for b in long if (long[a], long[b]) in pairs or (long[b], long[a]) in pairs}
    assert len(got) == len(set(got)) and {(a, b) for a, b, *_ in got} == expected
    assert all(n == counts[a] and m == counts[b] for a, b, n, m in got)


@pytest.mark.parametrize("typo, letters, least, ratio", [(199, 6, 5, 5), (3, 2, 2, 2)])
def test_variants_against_brute_force(spark, odd, none, typo, letters, least, ratio):
    rng = random.Random(9)
    rows, docs = odd
    words = ["Grundlage", "grundlagen", "GRUNDLAGE", "façades", "facades", "running", "runing", "Élan×vital", "éé", "a"]
    more = [(1000 + i, " ".join(rng.choice(words) for _ in range(60)) + ".") for i in range(60)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).withColumn("n", F.lit("clash"))
    expected = brute.variants([(i, t) for i, t, *_ in rows] + more, typo, letters, least, ratio)
    out = spelling.variants(both, typo=typo, min_letters=letters, min_count=least, ratio=ratio)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect()}
    assert got == expected and any(form for form, *_ in got.values())
    assert spelling.variants(none).count() == 0


def test_variants_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute.variants(docs.select("doc_id", "text").toPandas().itertuples(index=False, name=None), 199, 6, 5, 5)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).collect()}
    assert got == expected and len(got) > 100


def test_roots_follow_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("x", "w3"), ("y", "z")]
    got = dict(tuple(r) for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {f"w{i}": "w20" for i in range(20)} | {"x": "w20", "y": "z"}


def test_states_meet_one_row_of_edges(spark):
    words = spark.createDataFrame([(w, 5) for w in random_words(random.Random(1), 300)], "word string, n long")
    edges = spelling.trie(words).collect()
    assert len({(r.node, r.letter) for r in edges}) == len(edges) and all(r.label[0] == r.letter for r in edges)


# Alignment


@pytest.mark.parametrize("block_bytes", [1, 2000, alignment.BLOCK_BYTES])
def test_alignment_against_brute_force(spark, odd, none, block_bytes):
    rows, docs = odd
    texts = [t for _, t, *_ in rows]
    expected = Counter(zip((i for i, *_ in rows), brute.alignments(texts, queries.VOCABULARY, queries.OTHER_VOCABULARY)))
    out = alignment.alignments(docs, queries.VOCABULARY, queries.OTHER_VOCABULARY, block_bytes)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter((r[0], tuple(r)[1:]) for r in out.collect()) == expected
    assert sum(own[0] > 0 for _, own in expected) > 15 and any(own[0] == 0 and i == 22 for i, own in expected)
    assert alignment.alignments(none, queries.VOCABULARY, queries.OTHER_VOCABULARY).count() == 0


def test_alignment_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").toPandas()
    long = " ".join(docs.text.fillna("")) * 4  # several batches long
    rows = [*docs.itertuples(index=False, name=None), (-1, long)]
    assert len(long) > 1 << 20
    expected = dict(zip((i for i, _ in rows), brute.alignments([t for _, t in rows], queries.VOCABULARY, queries.OTHER_VOCABULARY)))
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in alignment.alignments(made, queries.VOCABULARY, queries.OTHER_VOCABULARY, 100_000).collect()}
    assert got == expected


def test_plain_lengths_are_the_spans():
    own = alignment.aligner(queries.VOCABULARY, queries.OTHER_VOCABULARY)
    text = "Plain words, with 'quotes' and (brackets) {x+=1}; 3.14\nnew line\ttab end"
    found = own.tokenizer.encode(" " + text, add_special_tokens=False)
    other = own.pieces.encode_as_offset_mapping(text)
    a, b = own.tokens(" " + text, (" " + text).encode())
    assert a.ids.tolist() == found.ids and a.ends.tolist() == [e for _, e in found.offsets]
    assert b.ids.tolist() == other["ids"] and b.ends.tolist() == [e + 1 for _, e in other["offsets"]]
