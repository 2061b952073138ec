"""Minimal perfect hashes in the manner of BBHash, on arrays of 128-bit keys.

Level by level, keys alone in their slot take it, the others go to the next level.
A key's number is the rank of its slot's bit among all bits, so n distinct keys get
the numbers 0 to n - 1. Keys not in the set get any number or none; a stored
fingerprint tells them apart.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.text import U64, mix

#: Slots for each key that is left, at each level.
SLOTS = 2


def _slots(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(one ^ mix(two + U64(level))) % U64(size)).astype(np.int64)


def build(one: np.ndarray, two: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, their bits one after the other (packed), and each key's number. Keys are distinct."""
    sizes, bits = [], []
    number = np.empty(len(one), np.int64)
    left, before = np.arange(len(one)), 0
    while len(left):
        size = -(-max(8, SLOTS * len(left)) // 8) * 8
        slot = _slots(one[left], two[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        placed = alone[slot]
        number[left[placed]] = before + np.cumsum(alone)[slot[placed]] - 1
        before += int(placed.sum())
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~placed]
        if len(sizes) > 200:
            raise ValueError("keys are not distinct")
    return sizes, np.concatenate(bits) if bits else np.empty(0, np.uint8), number


def find(sizes: list[int], packed: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The number of each key, or -1 for one that certainly is not in the set."""
    bits = np.unpackbits(packed)
    rank = np.cumsum(bits) - 1
    out = np.full(len(one), -1, np.int64)
    left, begin = np.arange(len(one)), 0
    for level, size in enumerate(sizes):
        at = begin + _slots(one[left], two[left], level, size)
        hit = bits[at] == 1
        out[left[hit]] = rank[at[hit]]
        left, begin = left[~hit], begin + size
    return out
