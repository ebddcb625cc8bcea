"""The perfect binary Golay code (23, 12): codeword indices near a 23-bit word."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

WORD_BITS, CHECK_BITS = 23, 11
GENERATOR = 0b101011100011
MOST_KEYS = 6


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return rest


@cache
def error_table() -> tuple[np.ndarray, np.ndarray]:
    """Error patterns of up to four bits by syndrome, and how many there are: one or six."""
    patterns = np.zeros((1 << CHECK_BITS, MOST_KEYS), np.int64)
    found = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        words = np.array([sum(1 << b for b in bits) for bits in combinations(range(WORD_BITS), weight)])
        for word, syndrome in zip(words, syndromes(words)):
            patterns[syndrome, found[syndrome]] = word
            found[syndrome] += 1
    return patterns, found


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within four bits of each word, six columns, and their number.

    Two words that differ in at most two bits have an index in common.
    """
    patterns, found = error_table()
    syndrome = syndromes(words)
    near = words.astype(np.int64)[:, None] ^ patterns[syndrome]
    return near >> CHECK_BITS, found[syndrome]
