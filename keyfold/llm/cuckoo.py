"""A cuckoo filter that keeps its keys (operator 4).

Every key may stand in one of two buckets of four slots. A slot holds a 16-bit fingerprint and, beside it,
the key with its entry, so a fingerprint that matches is verified against what the bucket holds. A key that
finds no room moves another to its other bucket; when that goes on too long the filter doubles and is filled
again from the keys it holds.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import Any

SLOTS = 4
MAX_MOVES = 200
_FINGERPRINT_SPREAD = 0x5BD1E9955BD1E995


class CuckooIndex:
    """Live digests (uniform bytes, 16 or more) and an entry for each."""

    def __init__(self, buckets: int = 64):
        self._clear(buckets)
        self.resizes = 0

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.size = 0
        self.fingerprints = array("H", bytes(2 * SLOTS * buckets))
        self.held: list[tuple[bytes, Any] | None] = [None] * (SLOTS * buckets)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        fingerprint = int.from_bytes(key[:2], "little") or 1  # 0 marks a free slot
        first = int.from_bytes(key[2:10], "little") & (self.buckets - 1)
        return fingerprint, first, self._other(first, fingerprint)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (((fingerprint * _FINGERPRINT_SPREAD) >> 24) & (self.buckets - 1))

    def _slot(self, key: bytes) -> int | None:
        """The slot of a key: fingerprints first, each hit verified against the key beside it."""
        fingerprint, first, second = self._places(key)
        for bucket in (first,) if first == second else (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.fingerprints[slot] == fingerprint and self.held[slot][0] == key:
                    return slot
        return None

    def get(self, key: bytes) -> Any:
        slot = self._slot(key)
        return None if slot is None else self.held[slot][1]

    def put(self, key: bytes, entry: Any) -> None:
        """Inserts a key, or gives a live one a new entry."""
        slot = self._slot(key)
        if slot is not None:
            self.held[slot] = (key, entry)
            return
        item = (key, entry)
        while (item := self._place(*item)) is not None:
            item = self._resize(item)
            if item is None:
                break
        self.size += 1

    def delete(self, key: bytes) -> bool:
        """Takes a live key out; False when it is not there."""
        slot = self._slot(key)
        if slot is None:
            return False
        self.fingerprints[slot] = 0
        self.held[slot] = None
        self.size -= 1
        return True

    def _place(self, key: bytes, entry: Any) -> tuple[bytes, Any] | None:
        """Puts a new key into a free slot, moving others if need be; returns the one left over."""
        fingerprint, first, second = self._places(key)
        for bucket in (first, second):
            if self._fill(bucket, fingerprint, key, entry):
                return None
        bucket = second
        for move in range(MAX_MOVES):
            slot = bucket * SLOTS + (move + key[10]) % SLOTS
            fingerprint, self.fingerprints[slot] = self.fingerprints[slot], fingerprint
            (key, entry), self.held[slot] = self.held[slot], (key, entry)
            bucket = self._other(bucket, fingerprint)
            if self._fill(bucket, fingerprint, key, entry):
                return None
        return key, entry

    def _fill(self, bucket: int, fingerprint: int, key: bytes, entry: Any) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.fingerprints[slot]:
                self.fingerprints[slot] = fingerprint
                self.held[slot] = (key, entry)
                return True
        return False

    def _resize(self, left_over: tuple[bytes, Any]) -> tuple[bytes, Any] | None:
        """Doubles the filter and fills it from the stored keys; returns what still finds no room."""
        items = [*self.items(), left_over]
        live = self.size
        buckets = self.buckets
        while True:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            if all(self._place(*item) is None for item in items):
                self.size = live
                return None

    def items(self) -> Iterator[tuple[bytes, Any]]:
        return (x for x in self.held if x is not None)

    def __len__(self) -> int:
        return self.size
