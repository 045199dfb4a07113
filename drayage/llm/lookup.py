"""A fixed table from 64-bit keys to 32-bit numbers that is looked up for whole arrays at a time."""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class Lookup:
    """Open addressing: a key's slot comes from its hash, and a taken slot sends it to the next."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - size.bit_length() + 1), size - 1
        self.key, self.value, self.probes = np.full(size, -1, np.int64), np.full(size, NONE, np.int32), 0
        while len(keys):
            slot = (self._slot(keys) + self.probes) & self.mask
            free = self.key[slot] == -1
            self.key[slot[free]] = keys[free]
            won = self.key[slot] == keys
            self.value[slot[won]] = values[won]
            keys, values = keys[~won], values[~won]
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NONE where it has none."""
        slot = self._slot(keys)
        at = self.key[slot]
        out = np.where(at == keys, self.value[slot], NONE)
        open_ = np.flatnonzero((at != keys) & (at != -1))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            at = self.key[slot]
            hit = at == keys[open_]
            out[open_[hit]] = self.value[slot[hit]]
            go = ~hit & (at != -1)
            open_, slot = open_[go], slot[go]
        return out
