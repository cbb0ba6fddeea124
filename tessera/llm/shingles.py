"""Word shingle sets of whole texts, as sorted arrays of 64-bit digests, and their MinHash signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm.common import MIX, digests, text_bytes

#: Fixed: words are separated by the space and the five controls from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct runs of ``size`` words of each text; the whole text as one run if it has fewer; none without words."""
    raw, offsets = text_bytes(texts)
    word = ~BLANK[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    row_at = offsets[:-1][np.diff(offsets) > 0]
    first[row_at] = word[row_at]
    last[row_at[row_at > 0] - 1] = word[row_at[row_at > 0] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    one, two = digests(raw, begin, end - begin)
    one = one ^ (two << np.uint64(1))
    cut = np.searchsorted(begin, offsets)

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(parts[0]), len(parts), np.uint64) * MIX[3]
        for x in parts:
            h = (h ^ x) * MIX[1]
            h ^= h >> np.uint64(32)
        return h

    runs = joined([one[i : len(one) - size + 1 + i] for i in range(size)]) if len(one) >= size else one[:0]
    sets = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(runs[a : b - size + 1]))
        else:
            sets.append(joined([one[i : i + 1] for i in range(a, b)]) if b > a else runs[:0])
    return sets


class MinHash:
    """Signatures of ``k`` coordinates: in each, the set's member that comes first in the coordinate's own order."""

    def __init__(self, k: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mask = rng.integers(0, 2**32, (k, 1), np.uint32)
        self.factor = rng.integers(0, 2**32, (k, 1), np.uint32) | np.uint32(1)
        self.salt = rng.integers(0, 2**63, k, np.uint64)

    def tokens(self, members: np.ndarray) -> np.ndarray:
        """The signature of a set that isn't empty as ``k`` numbers, each of which stands for a coordinate and its value."""
        low = (members >> np.uint64(32)).astype(np.uint32)
        best = np.zeros(len(self.salt), np.int64)
        least = np.full(len(self.salt), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(low), 4096):
            h = low[i : i + 4096] ^ self.mask
            h *= self.factor
            at = h.argmin(1)
            value = h[np.arange(len(at)), at]
            better = value < least if i else np.ones(len(at), bool)
            best[better], least[better] = at[better] + i, value[better]
        value = (members[best] ^ self.salt) * MIX[0]
        return (value ^ (value >> np.uint64(29))).view(np.int64)
