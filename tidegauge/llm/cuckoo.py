"""A cuckoo filter: approximate membership with insertion and deletion."""

from __future__ import annotations

import numpy as np

SLOTS = 4
_MAX_KICKS = 500
_SPREAD = 0x9E3779B97F4A7C15


def _marks(high: np.ndarray) -> np.ndarray:
    """Fingerprints of 16 bits; zero means a free slot."""
    marks = (high >> np.uint64(48)).astype(np.uint16)
    marks[marks == 0] = 1
    return marks


def _jump(marks: np.ndarray) -> np.ndarray:
    return (marks.astype(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(20)


class CuckooFilter:
    """Holds a multiset of 128-bit digests by a 16-bit fingerprint in one of two buckets.

    A digest that is in is always found. One that is not is found with a probability below
    8 / 65535. Only what was inserted may be deleted; the exact table beside it sees to that.
    """

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def of_size(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.7 < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        marks = _marks(digests[:, 1])
        first = digests[:, 0] & mask
        return marks, first, first ^ (_jump(marks) & mask)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        marks, first, second = self._places(digests)
        hit = (self.table[first] == marks[:, None]).any(axis=1)
        return hit | (self.table[second] == marks[:, None]).any(axis=1)

    def insert(self, digests: np.ndarray) -> bool:
        """False when there is no room; the filter has then to be built anew and larger."""
        marks, first, second = (x.tolist() for x in self._places(digests))
        table, mask = self.table, len(self.table) - 1
        for mark, a, b in zip(marks, first, second, strict=True):
            bucket = a
            for kick in range(_MAX_KICKS):
                if kick == 1:
                    bucket = b
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = mark
                    break
                if kick:
                    slot = kick % SLOTS
                    mark, table[bucket, slot] = int(table[bucket, slot]), mark
                    bucket ^= int(_jump(np.array([mark], dtype=np.uint16))[0]) & mask
            else:
                return False
        return True

    def delete(self, digests: np.ndarray) -> None:
        marks, first, second = (x.tolist() for x in self._places(digests))
        for mark, a, b in zip(marks, first, second, strict=True):
            for bucket in (a, b):
                slots = np.flatnonzero(self.table[bucket] == mark)
                if len(slots):
                    self.table[bucket, slots[0]] = 0
                    break
            else:
                raise KeyError("a digest to be deleted is not in the filter")


def build(digests: np.ndarray) -> CuckooFilter:
    """A filter that holds the digests, doubled in size until all have room."""
    size = len(digests)
    while True:
        made = CuckooFilter.of_size(size)
        if made.insert(digests):
            return made
        size = max(2 * size, 8)


class FilterSet:
    """The filters of all shards laid end to end, to look up many digests at once."""

    def __init__(self, shards: int, parts: dict[int, bytes]) -> None:
        self.shards = shards
        tables = [np.frombuffer(parts.get(s, b""), dtype="<u2") for s in range(shards)]
        tables = [t if len(t) else np.zeros(SLOTS, np.uint16) for t in tables]
        sizes = np.array([len(t) // SLOTS for t in tables], dtype=np.uint64)
        self.start = np.cumsum(sizes, dtype=np.uint64) - sizes
        self.mask = sizes - np.uint64(1)
        self.table = np.concatenate(tables).reshape(-1, SLOTS)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        shard = shard_of(digests, self.shards)
        mask, start = self.mask[shard], self.start[shard]
        marks = _marks(digests[:, 1])
        first = digests[:, 0] & mask
        second = first ^ (_jump(marks) & mask)
        hit = (self.table[start + first] == marks[:, None]).any(axis=1)
        return hit | (self.table[start + second] == marks[:, None]).any(axis=1)


def shard_of(digests: np.ndarray, shards: int) -> np.ndarray:
    return ((digests[:, 0] >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def as_digests(keys: list[bytes]) -> np.ndarray:
    """Sixteen-byte keys as rows of two unsigned numbers."""
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
