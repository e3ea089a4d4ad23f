"""A cuckoo filter whose slots also point at the stored keys."""

from __future__ import annotations

from array import array

_SLOTS = 4
_KICKS = 200


class CuckooIndex:
    """Live digests of one partition.

    Each bucket has four slots with a 16-bit fingerprint and the number of the
    stored entry. A digest may sit in two buckets, the second found from the first
    and the fingerprint alone. A fingerprint that hits is verified against the
    stored digest, so two digests with one fingerprint are never taken for each
    other. When a new digest finds no place within ``_KICKS`` moves the table is
    doubled and filled again from the stored digests.
    """

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.values: list = []
        self.live = 0
        self.resized = 0
        self._set_up(buckets)

    def _set_up(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._prints = array("H", bytes(2 * _SLOTS * buckets))
        self._entries = array("q", bytes(8 * _SLOTS * buckets))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self._mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self._mask)

    def _slot(self, digest: bytes) -> int:
        mark, first, second = self._places(digest)
        prints = self._prints
        for bucket in (first, second):
            for slot in range(bucket * _SLOTS, bucket * _SLOTS + _SLOTS):
                if prints[slot] == mark and self.keys[self._entries[slot]] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> int:
        """Number of the stored entry, -1 if the digest is not live."""
        slot = self._slot(digest)
        return -1 if slot < 0 else self._entries[slot]

    def insert(self, digest: bytes, value) -> int:
        """Adds a digest that is not live yet."""
        entry = len(self.keys)
        self.keys.append(digest)
        self.values.append(value)
        self.live += 1
        if not self._place(digest, entry):
            self._grow()
        return entry

    def delete(self, digest: bytes) -> bool:
        slot = self._slot(digest)
        if slot < 0:
            return False
        entry = self._entries[slot]
        self._prints[slot] = 0
        self.keys[entry] = self.values[entry] = None
        self.live -= 1
        return True

    def _place(self, digest: bytes, entry: int) -> bool:
        mark, first, second = self._places(digest)
        prints, entries = self._prints, self._entries
        bucket = first
        for kick in range(_KICKS):
            for place in (first, second) if kick == 0 else (bucket,):
                for slot in range(place * _SLOTS, place * _SLOTS + _SLOTS):
                    if not prints[slot]:
                        prints[slot], entries[slot] = mark, entry
                        return True
            slot = bucket * _SLOTS + kick % _SLOTS
            mark, prints[slot] = prints[slot], mark
            entry, entries[slot] = entries[slot], entry
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        """Twice the buckets, or more, until every stored digest has a place.
        Full copies of a bucket pair's hash bits beyond the table size end only by
        the digest's own 64 bits, which differ for different digests."""
        buckets = self._mask + 1
        while True:
            buckets *= 2
            self.resized += 1
            self._set_up(buckets)
            if all(self._place(k, i) for i, k in enumerate(self.keys) if k is not None):
                return

    def items(self):
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)
