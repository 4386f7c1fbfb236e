"""Character n-grams and words of texts as hashes, vectorised over a group of texts."""

from __future__ import annotations

import numpy as np

from . import kernels as K

_P = K.U64(0x100000001B3)


class Texts:
    """Consecutive texts as code points, with white space (space, 0x09-0x0D) as spaces and
    one space around every text."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [(t.lower() if lower else t) if t else "" for t in texts]
        points = np.frombuffer((" " + "".join(p + " " for p in parts)).encode("utf-32-le"), np.uint32).copy()
        points[(points >= 9) & (points <= 13)] = 32
        self.points = points.astype(K.U64)
        self.inside = points != 32
        self.bounds = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)])
        data = "".join(parts).encode()
        self.words = K.find_words(np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum([len(p.encode()) for p in parts], dtype=np.int64)]),
                                  K.ALNUM if lower else K.NONSPACE, K.SAME)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` (3 or more) characters from every position on, and whether they
        are part of one word, where its borders count as a character."""
        m = len(self.points) - n + 1
        if m <= 0:
            return np.zeros(0, K.U64), np.zeros(0, bool)
        out = np.full(m, n, K.U64)
        valid = np.ones(m, bool)
        for j in range(n):
            out *= _P
            out += self.points[j:j + m]
            if 0 < j < n - 1:
                valid &= self.inside[j:j + m]
        return K.mix(out), valid

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Text of positions of n-grams (a border space counts with the text before or after it)."""
        return np.clip(np.searchsorted(self.bounds, at, "right") - 1, 0, len(self.bounds) - 2)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum per text of values given by position."""
        total = np.concatenate([[0.0], np.cumsum(values)])
        ends = np.minimum(self.bounds, len(values))
        return total[ends[1:]] - total[ends[:-1]]

    def word_sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values)])
        return total[self.words.first[1:]] - total[self.words.first[:-1]]
