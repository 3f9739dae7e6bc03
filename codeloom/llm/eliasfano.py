"""Elias-Fano sequences and a two-level n-gram trie on them, both readable from a memory map."""

from __future__ import annotations

import mmap
import struct

import numpy as np

# Bits of a successor's hash that are kept below its context.
LOW = 40
_HEAD = "<QQQ"


def _packed(values: np.ndarray, width: int) -> bytes:
    """``width`` low bits of each value, one after the other."""
    if not width or not len(values):
        return b""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(raw, axis=1, count=None, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def narrow(numbers: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the least bytes that hold the largest."""
    top = int(np.max(numbers, initial=0))
    return np.asarray(numbers, next(f"<u{w}" for w in (1, 2, 4, 8) if top < 1 << (8 * w)))


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit numbers: low bits as they are, high bits in unary."""

    def __init__(self, data, at: int = 0):
        self.size, self.width, high_bytes = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, high_bytes, at), bitorder="little")
        # Place of the n-th one is n plus its high part; zeros end the high parts.
        self.high = (np.flatnonzero(bits)[: self.size] - np.arange(self.size)).astype(np.uint64)
        at += high_bytes
        low_bytes = -(-self.size * self.width // 8)
        self.low = np.concatenate((np.frombuffer(data, np.uint8, low_bytes, at), np.zeros(16, np.uint8)))
        self.end = at + low_bytes

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        size = len(values)
        top = int(values[-1]) + 1 if size else 1
        width = max(0, (top // max(size, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(size)
        bits = np.zeros((int(high[-1]) + 1) if size else 0, np.uint8)
        bits[high] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        return struct.pack(_HEAD, size, width, len(packed)) + packed + _packed(values, width)

    def get(self, places: np.ndarray) -> np.ndarray:
        """The numbers at ``places``."""
        places = np.asarray(places, np.int64)
        if not self.width:
            return self.high[places]
        bit = places * self.width
        byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
        window = np.zeros(len(places), np.uint64)
        for k in range(8):
            window |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        low = window >> shift
        over = shift.astype(np.int64) + self.width > 64
        if over.any():
            low[over] |= self.low[byte[over] + 8].astype(np.uint64) << (np.uint64(64) - shift[over])
        if self.width < 64:
            low &= np.uint64((1 << self.width) - 1)
        return (self.high[places] << np.uint64(self.width)) | low if self.width < 64 else low

    def all(self) -> np.ndarray:
        return self.get(np.arange(self.size))

    def successor(self, wanted: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
        """For each wanted number the first place in ``[first, last)`` that holds it or a larger one."""
        wanted = np.asarray(wanted, np.uint64)
        last = self.size if last is None else last
        top = wanted >> np.uint64(self.width) if self.width < 64 else np.zeros_like(wanted)
        # The high parts narrow the search to a few places, the low bits decide.
        low = np.maximum(np.searchsorted(self.high, top, "left"), first)
        high = np.minimum(np.searchsorted(self.high, top, "right"), last)
        high = np.maximum(high, low)
        while True:
            going = low < high
            if not going.any():
                return low
            middle = (low + high) >> 1
            less = np.zeros(len(wanted), bool)
            less[going] = self.get(middle[going]) < wanted[going]
            low = np.where(going & less, middle + 1, low)
            high = np.where(going & ~less, middle, high)


class Trie:
    """Contexts in order, and below each its successors in order.

    Level 1 is the sequence of context hashes; monotone pointers say where a context's successors begin;
    level 2 holds ``context number << 40 | successor hash``, which is monotone as a whole. Each level has a
    payload array, counts or codes, as wide as its largest number.
    """

    def __init__(self, data):
        self.contexts = EliasFano(data, 2)
        self.pointers = EliasFano(data, self.contexts.end)
        self.successors = EliasFano(data, self.pointers.end)
        at = self.successors.end
        self.context_payload = np.frombuffer(data, f"<u{data[0]}", self.contexts.size, at)
        self.payload = np.frombuffer(data, f"<u{data[1]}", self.successors.size, at + data[0] * self.contexts.size)

    @staticmethod
    def encode(contexts, counts, owner, successor, payload) -> bytes:
        """From sorted distinct ``contexts``, and pairs sorted by ``(owner, successor)``."""
        counts, payload = narrow(counts), narrow(payload)
        starts = np.searchsorted(owner, np.arange(len(contexts) + 1))
        return b"".join(
            (
                bytes([counts.itemsize, payload.itemsize]),
                EliasFano.encode(contexts),
                EliasFano.encode(starts),
                EliasFano.encode((owner.astype(np.uint64) << np.uint64(LOW)) | successor),
                counts.tobytes(),
                payload.tobytes(),
            )
        )

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Context number and successor hash of every entry of level 2."""
        flat = self.successors.all()
        return (flat >> np.uint64(LOW)).astype(np.int64), flat & np.uint64((1 << LOW) - 1)

    def find_contexts(self, wanted: np.ndarray) -> np.ndarray:
        """Numbers of contexts, -1 where there is none."""
        place = self.contexts.successor(wanted)
        inside = place < self.contexts.size
        found = np.full(len(place), -1)
        at = np.flatnonzero(inside)
        equal = self.contexts.get(place[at]) == np.asarray(wanted, np.uint64)[at]
        found[at[equal]] = place[at[equal]]
        return found

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Places in level 2, -1 where there is none: a successor search within the context's own range."""
        found = np.full(len(context), -1)
        known = np.flatnonzero(context >= 0)
        number = context[known]
        wanted = (number.astype(np.uint64) << np.uint64(LOW)) | successor[known]
        first, last = self.pointers.get(number).astype(np.int64), self.pointers.get(number + 1).astype(np.int64)
        place = self.successors.successor(wanted, first, last)
        at = np.flatnonzero(place < last)
        equal = self.successors.get(place[at]) == wanted[at]
        found[known[at[equal]]] = place[at[equal]]
        return found


def mapped(data: bytes):
    """``data`` in a memory map without a file, so no folder of the machine is used and the pages go with the map."""
    pages = mmap.mmap(-1, max(len(data), 1))
    pages.write(data)
    return pages
