"""Hashes of words and of runs of words, for many texts at once, in numpy.

Texts are joined as UTF-8 bytes.  A word is a run of word bytes (a table says which
bytes are), so no Python object is made per word.  All arithmetic is modulo 2**64 and
wraps on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C13)      # 3 modulo 8: differences of its powers keep most bits
_RUN_BASE = np.uint64(0xD1B54A32D192ED03)


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def _pow(base: np.uint64, n: int) -> np.ndarray:
    return _powers(int(base), 1 << max(19, int(n).bit_length()))[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@dataclass(frozen=True)
class Alphabet:
    """Which bytes are part of words, and the byte that stands for each."""

    word: np.ndarray
    lower: np.ndarray

    def values(self, seed: int) -> np.ndarray:
        own = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        return own[self.lower]


def _alphabet(is_word, lower: bool) -> Alphabet:
    return Alphabet(np.array([is_word(b) for b in range(256)]),
                    np.array([b + 32 if lower and 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8))


#: Words between ASCII white space, unchanged; the same with A-Z lower-cased; runs of
#: ASCII letters and digits and non-ASCII bytes, lower-cased.
SPACED = _alphabet(lambda b: b != 32 and not 9 <= b <= 13, False)
SPACED_LOWER = _alphabet(lambda b: b != 32 and not 9 <= b <= 13, True)
ALNUM_LOWER = _alphabet(lambda b: b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122, True)


@dataclass
class Words:
    """The words of some texts in order; ``first[i]`` is the number of words before text i."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    raw: np.ndarray


def split(parts: list[bytes], alphabet: Alphabet) -> Words:
    b = np.frombuffer(b"\n".join(parts), dtype=np.uint8)
    w = alphabet.word[b]
    edge = np.flatnonzero(np.diff(w.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    at = np.cumsum([0] + [len(p) + 1 for p in parts])
    return Words(starts, ends, np.searchsorted(starts, at), b)


def word_hashes(words: Words, alphabet: Alphabet, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's (lower-cased) bytes."""
    n = len(words.raw)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(alphabet.values(seed)[words.raw] * _pow(_BASE, n), out=sums[1:])
    h = (sums[words.ends] - sums[words.starts]) * _pow(_inverse(_BASE), n + 1)[words.starts]
    return mixed(h + (words.ends - words.starts).astype(np.uint64))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` neighbouring words (also across texts: drop those)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _pow(_RUN_BASE, len(hashes)), out=sums[1:])
    return mixed((sums[n:] - sums[:m]) * _pow(_inverse(_RUN_BASE), m))


def sequence_hash(hashes: np.ndarray) -> int:
    """One hash of a whole sequence of words, as of a run."""
    return int(runs(hashes, len(hashes))[0]) if len(hashes) else 0
