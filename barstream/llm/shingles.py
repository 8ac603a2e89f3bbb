"""Hashed word shingles and fast similarity sketches of one text (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

from barstream.llm.common import Bounded

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MULT1, MULT2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MULT1
    x = (x ^ (x >> np.uint64(27))) * MULT2
    return x ^ (x >> np.uint64(31))


def word_hasher() -> Bounded:
    import xxhash

    return Bounded(xxhash.xxh3_64_intdigest)


def shingle_set(text: str | None, words: int, hasher: Bounded) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles.

    A-Z are lower-cased; words are runs of anything but ASCII white space.  A
    text of fewer words, but not none, has its whole sequence as its shingle.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(hasher.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    last = len(parts) - n + 1
    code = np.full(last, n, np.uint64)
    for i in range(n):
        code = mix(code ^ one[i : i + last])
    return np.unique(code)


class Sketcher:
    """Fast similarity sketching in t bins.

    Round i < t hashes every element into one of t bins with the value
    (i, hash), a bin keeping its least; round t + j puts every element into
    bin j.  Rounds stop once all bins are filled: after two or three for a set
    of many elements, after 2t at the latest.
    """

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.t = bands, rows, bands * rows
        self.seeds = mix(np.arange(1, 2 * self.t + 1, dtype=np.uint64) * GOLDEN)
        self.salt = mix(np.arange(self.t, dtype=np.uint64) + np.uint64(77))

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        filled = np.zeros(self.t, bool)
        out = np.zeros(self.t, np.uint64)
        bins_of = np.uint64(self.t)
        for i, seed in enumerate(self.seeds):
            code = mix(elements ^ seed)
            if i < self.t:
                order = np.argsort(code)
                code = code[order]
                bins = ((code & np.uint64(0xFFFFFFFF)) % bins_of).astype(np.int64)
                seen, first = np.unique(bins, return_index=True)  # the least code of each bin, as codes are sorted
                new = ~filled[seen]
                out[seen[new]] = code[first[new]]
                filled[seen] = True
            elif not filled[i - self.t]:
                out[i - self.t] = code.min()
                filled[i - self.t] = True
            if filled.all():
                break
        return out

    def band_keys(self, elements: np.ndarray) -> list[int]:
        """One signed 64-bit key per band; equal rows of a band give equal keys."""
        codes = mix(self.sketch(elements) ^ self.salt).reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for r in range(self.rows):
            key = mix(key ^ codes[:, r])
        return key.view(np.int64).tolist()
