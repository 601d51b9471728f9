"""Word shingles of a text as sorted distinct 64-bit hashes, vectorised with numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5

_MASK = (1 << 64) - 1


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` 64-bit values of the splitmix64 sequence."""
    x = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(seed & _MASK)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# each byte's value in a word's hash; A-Z as a-z, white space (\x20, \x09-\x0D) none
_BYTES = splitmix(256, 1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_ORDER = splitmix(WORDS, 2) | np.uint64(1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Keeps the power tables between texts."""

    def __init__(self):
        self.up, self.down = powers(_STEP, 1 << 16), powers(_BACK, 1 << 16)

    def words(self, data: bytes) -> np.ndarray:
        """One hash for each word, in order."""
        raw = np.frombuffer(data, np.uint8)
        inside = ~_SPACE[raw]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.empty(0, np.uint64)
        if len(raw) > len(self.up):
            n = 1 << int(len(raw) - 1).bit_length()
            self.up, self.down = powers(_STEP, n), powers(_BACK, n)
        values = _BYTES[raw] * self.up[:len(raw)]
        values[~inside] = 0
        sums = np.add.reduceat(values, starts)
        return mix(sums * self.down[starts] + (ends - starts).astype(np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes; a text of fewer words is one shingle of all its
        words; none without words."""
        words = self.words((text or "").encode("utf-8", "surrogatepass"))
        if not len(words):
            return words
        if len(words) < WORDS:
            return mix((words * _ORDER[:len(words)]).sum(keepdims=True) + np.uint64(len(words)))
        n = len(words) - WORDS + 1
        sums = np.zeros(n, np.uint64)
        for j in range(WORDS):
            sums += words[j:j + n] * _ORDER[j]
        return np.unique(mix(sums))
