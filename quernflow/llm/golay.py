"""The binary Golay code (23, 12): it is perfect, so every 23-bit word lies within distance 3 of exactly one codeword.

``nearby`` gives the codewords that words at distance 0 or 1 of a word decode to: one, or six when the word is at distance 3
of its own codeword. Two words at distance 2 or less have one of them in common, that of the word midway between them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
MOST_KEYS = 6


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of each 12-bit message; error pattern of each 11-bit syndrome. Both follow from the generator."""
    word = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        word = np.where(word >> bit & 1, word ^ (GENERATOR << (bit - 11)), word)
    check = word
    errors = [0] + [1 << a for a in range(23)]
    errors += [1 << a | 1 << b for a in range(23) for b in range(a)]
    errors += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
    errors = np.array(errors, dtype=np.int64)
    pattern = np.zeros(1 << 11, dtype=np.int64)
    pattern[check[errors >> 11] ^ (errors & 0x7FF)] = errors
    return check, pattern


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    check, pattern = _tables()
    return (words ^ pattern[check[words >> 11] ^ (words & 0x7FF)]) >> 11


def nearby(words: np.ndarray, width: int = 23) -> np.ndarray:
    """For words of ``width`` used bits, an array (n, 6) of codeword indices, padded with -1."""
    words = words.astype(np.int64)
    flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    again = np.zeros(found.shape, dtype=bool)
    again[:, 1:] = found[:, 1:] == found[:, :-1]
    found = np.sort(np.where(again, 1 << 12, found), axis=1)[:, :MOST_KEYS]
    return np.where(found == 1 << 12, -1, found)
