"""Minimal perfect hashes of sets of whole numbers, in numpy arrays.

A key gets the first level on which no other key of its set falls into the same slot; there its
slot has a bit. The number of a key is the number of bits before its own, so the numbers of n
keys are 0 to n - 1. About four bits are needed for a key. A number says nothing of keys outside
the set, so the keys are kept in order of their numbers and compared.

Sets are kept by bucket: `build` makes the hash of one bucket, `Index` looks keys up in many.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from punctual.llm.packed_keys import mix

#: Slots for each key that a level has to place.
ROOM = 2


def _slots(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(mix(keys ^ salt) + salt) % np.asarray(size).astype(np.uint64)).astype(np.int64)


@dataclass
class Bucket:
    """Sizes of the levels, their bits one after the other, and the keys by number."""

    sizes: np.ndarray
    bits: np.ndarray
    keys: np.ndarray


def build(keys: np.ndarray) -> Bucket:
    """The hash of distinct `keys` (unsigned 64-bit)."""
    sizes, bits, placed, rest, level = [], [], [], keys, 0
    while len(rest):
        size = ROOM * len(rest)
        slot = _slots(rest, level, size)
        met = np.bincount(slot, minlength=size)
        alone = met[slot] == 1
        order = np.argsort(slot[alone])
        sizes.append(size)
        bits.append(met == 1)
        placed.append(rest[alone][order])
        rest, level = rest[~alone], level + 1
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return Bucket(np.array(sizes, np.int64), join(bits, bool), join(placed, np.uint64))


class Index:
    """Numbers of keys over several buckets; those of bucket i come after those of bucket i - 1."""

    def __init__(self, buckets: list[Bucket]):
        levels = max((len(b.sizes) for b in buckets), default=0)
        self.size = np.zeros((levels, len(buckets)), np.int64)
        for at, bucket in enumerate(buckets):
            self.size[: len(bucket.sizes), at] = bucket.sizes
        ends = np.cumsum(self.size.T.ravel()).reshape(len(buckets), levels).T
        self.start = ends - self.size
        self.bits = np.concatenate([b.bits for b in buckets]) if buckets else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits, dtype=np.int64) - 1
        self.keys = np.concatenate([b.keys for b in buckets]) if buckets else np.zeros(0, np.uint64)
        self.first = np.cumsum([0, *(len(b.keys) for b in buckets)])

    def numbers(self, keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The number of each key, given the place of its bucket in the list; -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level in range(len(self.size)):
            size = self.size[level, bucket]
            has = size > 0
            if not has.all():
                keys, bucket, open_, size = keys[has], bucket[has], open_[has], size[has]
            if not len(keys):
                break
            at = self.start[level, bucket] + _slots(keys, level, size)
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]]
            keys, bucket, open_ = keys[~hit], bucket[~hit], open_[~hit]
        return out

    def verified(self, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """`numbers`, with -1 where the key kept there is another one."""
        held = np.append(self.keys, np.uint64(0))[numbers]  # number -1 meets the last
        return np.where((numbers >= 0) & (held == keys), numbers, -1)
