"""Shingle sets, MinHash samples and odd sketches of texts (numpy, no Spark)."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import worker_memo

MEMO_WORDS = 500_000
STEP = 2048


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct ``size``-word shingles of the whole text, as sorted 64-bit hashes.

    A text with fewer words, but not none, is one shingle; no words, no shingles.
    """
    # of bytes, lower() changes A-Z alone and split() cuts at space and \x09-\x0d alone
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "u8")
    hashes = worker_memo("odd_sketch").setdefault("word hashes", _WordHashes())
    each = np.fromiter(map(hashes.__getitem__, words), "u8", len(words))
    n = max(len(words) - size + 1, 1)
    # the number of words is part of the hash: a short whole is no shingle of a longer text
    state = np.full(n, min(size, len(words)), "u8")
    for k in range(min(size, len(words))):
        state = _mix(state * np.uint64(0x9E3779B97F4A7C15) + each[k:k + n])
    return np.unique(state)


class Family:
    """``samples`` hash functions, ``bands`` bands of ``rows`` samples, and a sketch of ``bits`` bits."""

    def __init__(self, samples: int, bands: int, rows: int, bits: int, seed: int):
        if bands * rows > samples:
            raise ValueError("more bands than samples")
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 1 << 63, samples, "u8") * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(0, 1 << 63, samples, "u8")
        self.bands, self.rows, self.bits = bands, rows, bits
        self.numbers = np.arange(samples, dtype="u8")

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest value of every hash function over a non-empty set."""
        least = None
        for at in range(0, hashes.size, STEP):
            part = hashes[at:at + STEP]
            low = ((part[None, :] * self.factor[:, None] + self.shift[:, None]) >> np.uint64(24)).min(axis=1)
            least = low if least is None else np.minimum(least, low)
        return least

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        used = samples[:self.bands * self.rows].reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype="u8")
        for k in range(self.rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + used[:, k])
        return key.view("i8")

    def sketch(self, samples: np.ndarray) -> bytes:
        """Parity of how many (function, sample) pairs fall on each bit.

        What two sets share cancels out in the XOR of their sketches; its ones
        count the pairs in which they differ.
        """
        place = _mix(samples * np.uint64(0x9E3779B97F4A7C15) + self.numbers) % np.uint64(self.bits)
        odd = np.bincount(place.astype("i8"), minlength=self.bits) & 1
        return np.packbits(odd.astype("u1")).tobytes()


def largest_distance(samples: int, bits: int, percent: int, deviations: float = 6.0) -> int:
    """Ones in the XOR above which two sets are at least ``percent`` similar with negligible chance.

    At similarity j, d = 2 k (1 - j) pairs differ in the mean, spread like a
    binomial; d pairs leave n (1 - (1 - 2 / n)^d) / 2 odd bits in the mean. The
    cut lies ``deviations`` standard deviations above both.
    """
    j = percent / 100
    differ = 2 * (samples * (1 - j) + deviations * np.sqrt(samples * j * (1 - j)))
    differ = min(differ, 2 * samples)
    odd = bits * (1 - (1 - 2 / bits) ** differ) / 2
    clash = differ**2 / (2 * bits)
    return int(np.ceil(odd + np.sqrt(4 * clash)))
