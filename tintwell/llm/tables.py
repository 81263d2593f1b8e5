"""Open hash tables from 64-bit to 32-bit numbers, looked up and filled by whole arrays."""

from __future__ import annotations

import numpy as np

_TIMES = np.uint64(0x9E3779B97F4A7C15)

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Table:
    """Keys are numbers from 0 on; a missing key reads as -1. It is never more than half full."""

    def __init__(self, room: int = 1024):
        self._empty(room)

    def _empty(self, room: int) -> None:
        bits = (2 * room).bit_length()
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values, self.used = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, -1, np.int32), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _TIMES) >> self.shift).view(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that the table does not hold."""
        if 2 * (self.used + len(keys)) > self.mask:
            old = self.keys >= 0
            held = self.keys[old], self.values[old]
            self._empty(2 * (self.used + len(keys)))
            self.put(*held)
        self.used += len(keys)
        keys = keys.astype(np.int64, copy=False)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            first = left[free][np.unique(slot[left][free], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.int64, copy=False)
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        todo = np.flatnonzero((there != keys) & (there >= 0))
        key, slot = keys[todo], slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            there = self.keys[slot]
            hit = there == key
            out[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (there >= 0)
            todo, key, slot = todo[more], key[more], slot[more]
        return out
