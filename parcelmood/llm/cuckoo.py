"""A cuckoo filter over 64-bit keys in numpy arrays: insertion, deletion, resizing from the stored keys."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Relocations before a filter counts as full.
MAX_KICKS = 200
_MASK = (1 << 64) - 1


def mixed(value: int) -> int:
    """A 64-bit finaliser; spreads the bits of a key."""
    value = (value ^ (value >> 33)) * 0xFF51AFD7ED558CCD & _MASK
    value = (value ^ (value >> 33)) * 0xC4CEB9FE1A85EC53 & _MASK
    return value ^ (value >> 33)


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a key lives in one of two buckets.

    ``insert`` tells whether there was room. It never loses a key: a filter that is full puts the relocations back
    and leaves the caller to build a larger one from its stored keys.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets is a power of two")
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        """Room for so many keys at a load of at most 0.8."""
        buckets = 1
        while buckets * SLOTS * 0.8 < keys:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def holding(cls, keys, at_least: int = 0) -> "CuckooFilter":
        """A filter with these keys, doubled until all find room."""
        keys = list(keys)
        made = cls.sized(max(len(keys), at_least, 1))
        while not all(made.insert(k) for k in keys):
            made = cls(made.buckets * 2)
        return made

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, key: int) -> tuple[int, int, int]:
        """Fingerprint (never 0) and the two buckets."""
        h = mixed(key & _MASK)
        print_ = (h >> 48) or 1
        first = h & (self.buckets - 1)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return (bucket ^ mixed(print_)) & (self.buckets - 1)

    def __contains__(self, key: int) -> bool:
        print_, a, b = self.places(key)
        return print_ in self.table[a] or print_ in self.table[b]

    def _put(self, bucket: int, print_: int) -> bool:
        row = self.table[bucket]
        for slot in range(SLOTS):
            if not row[slot]:
                row[slot] = print_
                return True
        return False

    def insert(self, key: int) -> bool:
        print_, a, b = self.places(key)
        if self._put(a, print_) or self._put(b, print_):
            return True
        moved, bucket = [], a
        for step in range(MAX_KICKS):
            slot = (key + step) % SLOTS
            moved.append((bucket, slot))
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            bucket = self._other(bucket, print_)
            if self._put(bucket, print_):
                return True
        for bucket, slot in reversed(moved):
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
        return False

    def delete(self, key: int) -> bool:
        """Remove one fingerprint of a key that was inserted; only such keys may be deleted."""
        print_, a, b = self.places(key)
        for bucket in (a, b):
            for slot in range(SLOTS):
                if self.table[bucket, slot] == print_:
                    self.table[bucket, slot] = 0
                    return True
        return False
