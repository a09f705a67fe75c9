"""Hash table of 64-bit keys for whole numpy arrays at a time."""

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class HashTable:
    """Maps distinct uint64 keys to their int32 values by open addressing; absent keys give -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * max(len(keys), 1) - 1).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            free = self.values[slots] < 0
            _, first = np.unique(slots[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slots[won]], self.values[slots[won]] = keys[left[won]], values[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slots = left[rest], (slots[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.values[slots]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slots] != keys))
        slots = slots[wrong]
        while len(wrong):
            slots = (slots + 1) & self.mask
            found[wrong] = self.values[slots]
            again = (found[wrong] >= 0) & (self.keys[slots] != keys[wrong])
            wrong, slots = wrong[again], slots[again]
        return found
