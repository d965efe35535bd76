"""Words of a text as 64-bit hashes, and hash mixing in arrays."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Hash of each word met; emptied when full, which changes no hash."""

    limit = 150_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def words(text: str | None) -> list[str]:
    """Lower-cased runs of word characters; a null text has none."""
    return WORD.findall((text or "").lower())


def word_hashes(found: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that changes about half of the bits (the splitmix64 finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Hashes mixed with a number, independent from salt to salt."""
    return mix(x + np.uint64(salt * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (x >> np.uint64(11)) * (1.0 / (1 << 53))


def runs(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed)) | np.uint64(1)
    total = np.zeros(count, np.uint64)
    for i, factor in enumerate(factors):
        total += hashes[i : i + count] * factor
    return mix(total)
