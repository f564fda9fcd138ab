"""The perfect binary Golay code of 23 bits, as a fuzzy hash: words that differ in one or two bits share a key."""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

LENGTH, INDEX_BITS = 23, 12
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of each byte at its place, and the error pattern of each remainder."""
    single = [_remainder(1 << i) for i in range(LENGTH)]
    of_byte = np.zeros((3, 256), dtype=np.int64)
    for place in range(3):
        for value in range(256):
            for i in range(8):
                if value >> i & 1 and 8 * place + i < LENGTH:
                    of_byte[place, value] ^= single[8 * place + i]
    pattern = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            at = 0
            for i in bits:
                at ^= single[i]
            pattern[at] = sum(1 << i for i in bits)
    return of_byte, pattern


def index_of(words: np.ndarray) -> np.ndarray:
    """Index, below 4096, of the one code word within three bits of each 23-bit word."""
    of_byte, pattern = _tables()
    left = of_byte[0][words & 255] ^ of_byte[1][words >> 8 & 255] ^ of_byte[2][words >> 16 & 127]
    return (words ^ pattern[left]) >> 11


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Indices of each word and of those that differ in one of the lower ``bits`` bits, a row for each
    word, sorted. At most 6 values of a row differ: a word within two bits of its code word has one,
    and one at three bits has those of the code words at four bits besides."""
    flips = np.array([0, *(1 << i for i in range(bits))], dtype=np.int64)
    return np.sort(index_of(words[:, None] ^ flips), axis=1)
