"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
M64 = (1 << 64) - 1


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def line_dedup(rows):
    """(text, lines removed) for rows of (doc_id, text), distinct by both, in any order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        text = rows[i][1]
        if text is None:
            out[i] = (None, 0)
            continue
        lines, covered = text.split("\n"), set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not any(x.strip(" ") for x in window):
                continue
            if window in seen:
                covered |= {at, at + 1, at + 2}
            seen.add(window)
        out[i] = ("\n".join(x for j, x in enumerate(lines) if j not in covered), len(covered))
    return [out[i] for i in range(len(rows))]


def simhash(text: str | None) -> int:
    words = [x for x in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if x]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and linked(a, b):
                parent[find(b)] = find(a)
    return {v: find(v) for v in parent}


def spark_hash(*parts) -> int:
    """xxhash64 of longs, ints and texts, as Spark chains it, unsigned."""
    seed = 42
    for kind, value in parts:
        if kind == "text":
            seed = xxhash.xxh64_intdigest(value.encode(), seed)
        elif kind == "long":
            seed = xxhash.xxh64_intdigest((value & M64).to_bytes(8, "little"), seed)
        else:
            seed = xxhash.xxh64_intdigest((value & 0xFFFFFFFF).to_bytes(4, "little"), seed)
    return seed


def fingerprint(text: str, samples: int) -> str:
    """Consistent weighted sampling, term by term."""
    weights = Counter(x for x in re.split(r"[\x20\x09-\x0D]+", text) if x)
    uniform = lambda h, first: ((h >> first & ((1 << 21) - 1)) + 0.5) / (1 << 21)
    out = []
    for i in range(samples):
        best = []
        for word, weight in weights.items():
            term = spark_hash(("text", word))
            h, g = spark_hash(("long", term), ("int", 2 * i)), spark_hash(("long", term), ("int", 2 * i + 1))
            r, c, b = -math.log(uniform(h, 0) * uniform(h, 21)), -math.log(uniform(h, 42) * uniform(g, 0)), uniform(g, 21)
            t = math.floor(math.log(weight) / r + b)
            high = math.floor((math.log(c) - r * (t - b) - r + 128) * (1 << 23))
            best.append((high, spark_hash(("long", term), ("long", t)) & 0xFFFFFFFF))
        out.append(f"{min(best)[1] if best else 0:08x}")
    return "".join(out)


def jaccard(a: str, b: str) -> float:
    x, y = (Counter(re.split(r"[\x20\x09-\x0D]+", t)) for t in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def nearest(ids, vectors, query, k):
    d = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[query]]
    return [(int(ids[i]), float(d[i])) for i in order[:k]]


class KneserNey:
    """Straight from the definition: counts of the longest sequences, kinds before shorter ones."""

    def __init__(self, texts, order, characters):
        self.order, self.characters = order, characters
        full = Counter(g for t in texts for g in self._grams(t, order))
        self.counts = {order: full}
        for k in range(order - 1, 0, -1):
            longer = {g for t in texts for g in self._grams(t, k + 1)}
            self.counts[k] = Counter(g[1:] for g in longer)
        self.discount = {}
        for k, c in self.counts.items():
            ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            self.discount[k] = min(0.9, max(0.1, ones / (ones + 2 * twos) if ones + 2 * twos else 0.5))

    @staticmethod
    def _grams(text, k):
        padded = " " * 3 + text
        return [padded[i - k + 1 : i + 1] for i in range(3, len(padded))]

    def p(self, gram):
        if not gram:
            return 1 / self.characters
        c, d = self.counts[len(gram)], self.discount[len(gram)]
        own = {g: n for g, n in c.items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        if not total:
            return self.p(gram[1:])
        return max(c[gram] - d, 0) / total + d * len(own) / total * self.p(gram[1:])

    def cross_entropy(self, text):
        grams = self._grams(text, self.order)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def repetition(text: str | None, least: int, most_covered: int, most_repeat: int):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest repeat, repeats, base_failed, kept."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)

    def places(m):
        found = {}
        for i in range(n - m + 1):
            found.setdefault(tuple(words[i : i + m]), []).append(i)
        return [x for x in found.values() if len(x) > 1]

    def covered(m):
        return len({i + k for x in places(m) for i in x for k in range(m)})

    longest, repeats, m = 0, 0, least
    while own := places(m):
        longest = m
        for x in own:
            left = {words[i - 1] if i else None for i in x}
            right = {words[i + m] if i + m < n else None for i in x}
            repeats += (len(left) > 1) and (len(right) > 1)
        m += 1
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = n < 10 or 100 * covered(5) > 20 * n
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), covered(5), covered(least), longest, repeats,
        failed, not failed and 100 * covered(least) <= most_covered * n and longest <= most_repeat,
    )


def variants(docs, typo, min_letters, min_count, ratio):
    """word: (form, root, n, n_near, form_n) for rows of (doc_id, text)."""
    import zlib

    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % typo == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(w, v))
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = (form, n, len(near), -near[0][0] if form else None)
    root = lambda w: root(out[w][0]) if out[w][0] else w
    return {w: (form, root(w), n, near, m) for w, (form, n, near, m) in out.items()}


def alignments(texts, a_path, b_path):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text; whole texts, byte by byte."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(a_path)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(a_path, encoding="utf-8") as file:
        name_of = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    rows, held = [], Counter()
    for text in texts:
        groups = []
        if text:
            a = tokenizer.encode(" " + text, add_special_tokens=False).ids
            b = pieces.encode(text)
            bytes_a = [bytes(to_byte[c] for c in name_of[i]) for i in a]
            names = [pieces.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(x[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", x) else x.replace("▁", " ").encode() for x in names]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                i = j = at_a = at_b = 0
                own_a, own_b = [], []
                while i < len(a) or j < len(b):
                    if at_a <= at_b and i < len(a):
                        own_a.append(a[i])
                        at_a += len(bytes_a[i])
                        i += 1
                    else:
                        own_b.append(b[j])
                        at_b += len(bytes_b[j])
                        j += 1
                    if at_a == at_b:
                        groups.append((own_a, own_b))
                        own_a, own_b = [], []
        links = [(x, y) for p, q in groups for x in p for y in q]
        held.update(set(links))
        rows.append((groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (
            sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
            sha(";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups).encode()) if groups else "",
        )
        for groups, links in rows
    ]


def common(a, b) -> int:
    """Length of the longest common subsequence."""
    row, known = [0] * (len(b) + 1), set(b)
    for x in a:
        if x not in known:
            continue
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]
