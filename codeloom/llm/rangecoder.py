"""Adaptive range coder for token ids: order-0 to order-2 predictions, many independent blocks side by side."""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CLM1"
BLOCK = 2048
# Hashed contexts a block remembers, as powers of two.
BITS2, BITS1 = 10, 9
# Coding intervals are shares of these powers of two.
SHARE, SLOTS = 16, 13
# A settled span has more bits than the three steps of one id take together.
WIDE, NARROW = np.uint64(48), np.uint64(1 << 40)
ONE = 1 << SHARE
# Hit rates move by one part in two to this power.
RATE = 4
# Ids between two renewals of the order-0 shares.
RENEW = 256
GAIN = 24


def _buckets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order-0 classes of ids: narrow for small ids, which are frequent, and wider beyond."""
    starts, widths = [], []
    for low, high, bits in ((0, 1024, 2), (1024, 4096, 4), (4096, 16384, 6), (16384, 65536, 8)):
        for start in range(low, high, 1 << bits):
            starts.append(start)
            widths.append(bits)
    sizes = [1 << w for w in widths]
    return np.array(starts), np.array(widths, np.uint64), np.repeat(np.arange(len(starts)), sizes)


STARTS, WIDTHS, BUCKET_OF = _buckets()
BUCKETS = len(STARTS)
PRIOR = np.maximum(1, 40 * np.log((STARTS + (1 << WIDTHS.astype(int)) + 64) / (STARTS + 64))).astype(np.int64)


class Model:
    """What the coder knows of each block so far; one row per block. Integers only, so any machine agrees.

    A context entry is ``(id + 1) * 4 + trust`` with trust 0 (new), 1 (seen) or 3 (confirmed).
    """

    def __init__(self, blocks: int):
        self.rows = np.arange(blocks)
        self.older = np.zeros(blocks, np.int64)
        self.last = np.zeros(blocks, np.int64)
        self.table2 = np.zeros(blocks << BITS2, np.int32)
        self.table1 = np.zeros(blocks << BITS1, np.int32)
        # Hit rates of both predictions, mixed by the trust in each and by whether they agree.
        trust2, trust1 = np.arange(32) & 3, np.arange(32) >> 2 & 3
        agree = np.arange(32) >> 4 == 1
        self.rate2 = np.tile(np.where(trust2 > 0, ONE // 3, 0).astype(np.int32), blocks)
        self.rate1 = np.tile(np.where((trust1 > 0) & ~agree, ONE // 4, 0).astype(np.int32), blocks)
        self.row2, self.row1, self.row32 = self.rows << BITS2, self.rows << BITS1, (self.rows << 5).astype(np.int32)
        self.counts = np.tile(PRIOR.astype(np.int32), (blocks, 1))
        self.steps = 0
        self._renew(blocks)

    def _renew(self, active: int) -> None:
        """Order-0 shares from the counts: at least one slot per class, all slots given out."""
        sums = np.cumsum(self.counts[:active], axis=1, dtype=np.int64)
        spare = (1 << SLOTS) - BUCKETS
        self.ends = np.zeros((active, BUCKETS + 1), np.int64)
        self.ends[:, 1:] = np.arange(1, BUCKETS + 1) + sums * spare // sums[:, -1:]
        self.flat_ends = (self.ends[:, 1:] + (np.arange(active) << SLOTS)[:, None]).ravel()

    def predict(self, active: int) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the intervals of the order-2 and the order-1 prediction below ``ONE``.

        A prediction that cannot hit has an empty interval; one that can has at least one share.
        """
        last = self.last[:active] * 2654435761
        self.at2 = self.row2[:active] + (((last + self.older[:active]) * 2246822519 >> 19) & ((1 << BITS2) - 1))
        self.at1 = self.row1[:active] + ((last >> 19) & ((1 << BITS1) - 1))
        self.entry2, self.entry1 = self.table2.take(self.at2), self.table1.take(self.at1)
        self.guess2, self.guess1 = self.entry2 >> 2, self.entry1 >> 2
        agree = (self.guess2 == self.guess1).view(np.int8).astype(np.int32)
        self.joint = self.row32[:active] + (self.entry2 & 3) + ((self.entry1 & 3) << 2) + (agree << 4)
        self.old2, self.old1 = self.rate2.take(self.joint), self.rate1.take(self.joint)
        # Rates stay between 15 and ONE - 15 once a prediction can hit, so something is left for a miss.
        end1 = self.old2 + ((ONE - self.old2).astype(np.int64) * self.old1 >> SHARE) + (self.old1 > 0)
        return self.old2, end1

    def update(self, active: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, missed: np.ndarray) -> None:
        self.rate2[self.joint] = np.where(hit2, self.old2 + (ONE - self.old2 >> RATE), self.old2 - (self.old2 >> RATE))
        self.rate1[self.joint] = np.where(
            hit2, self.old1, np.where(hit1, self.old1 + (ONE - self.old1 >> RATE), self.old1 - (self.old1 >> RATE))
        )
        fresh = ((ids + 1) << 2) + 1
        self.table2[self.at2] = np.where(hit2, self.entry2 | 3, fresh)
        self.table1[self.at1] = np.where(self.guess1 == ids + 1, self.entry1 | 3, fresh)
        self.older[:active] = self.last[:active]
        self.last[:active] = ids
        self.counts[missed, BUCKET_OF.take(ids[missed])] += GAIN
        self.steps += 1
        if self.steps % RENEW == 0:
            self._renew(active)


def _lay(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as one row per block, and the blocks' lengths; only the last block may be shorter."""
    blocks = -(-len(ids) // BLOCK)
    table = np.zeros(blocks * BLOCK, np.int32)
    table[: len(ids)] = ids
    sizes = np.full(blocks, BLOCK)
    if blocks:
        sizes[-1] = len(ids) - BLOCK * (blocks - 1)
    return table.reshape(blocks, BLOCK), sizes


class _Spans:
    """Interval of each block. Settling shifts out the leading 16 bits that no later step can change; a
    span that has become too narrow is cut so that they cannot."""

    low: np.ndarray
    span: np.ndarray

    def shift(self, at: np.ndarray) -> None:
        raise NotImplementedError

    def narrow(self, at, start, width, bits) -> None:
        """``at``: a slice, or the numbers of some blocks."""
        unit = self.span[at] >> bits
        self.low[at] += unit * start.astype(np.uint64)
        self.span[at] = unit if width is None else unit * width.astype(np.uint64)

    def settle(self, active: int) -> None:
        low, span = self.low[:active], self.span[:active]
        fixed = ((low ^ (low + span)) >> WIDE) == 0
        at = np.flatnonzero(fixed | (span < NARROW))
        fixed = fixed[at]
        while len(at):
            short = at[~fixed]
            self.span[short] = (~self.low[short] + np.uint64(1)) & (NARROW - np.uint64(1))
            self.shift(at)
            low, span = self.low[at] << np.uint64(16), self.span[at] << np.uint64(16)
            self.low[at], self.span[at] = low, span
            fixed = ((low ^ (low + span)) >> WIDE) == 0
            ready = np.flatnonzero(fixed | (span < NARROW))
            at, fixed = at[ready], fixed[ready]


class _Writer(_Spans):
    def __init__(self, blocks: int):
        self.low = np.zeros(blocks, np.uint64)
        self.span = np.full(blocks, np.uint64(2**64 - 1))
        self.words = np.zeros((blocks, 3 * BLOCK + 8), np.uint16)
        self.used = np.zeros(blocks, np.int64)

    def shift(self, at: np.ndarray) -> None:
        self.words[at, self.used[at]] = self.low[at] >> WIDE
        self.used[at] += 1


class _Reader(_Spans):
    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.words = np.concatenate((words, np.zeros(8, np.uint16))).astype(np.uint64)
        self.at = starts.astype(np.int64)
        self.low = np.zeros(len(starts), np.uint64)
        self.span = np.full(len(starts), np.uint64(2**64 - 1))
        self.code = np.zeros(len(starts), np.uint64)
        for _ in range(4):
            self.code = (self.code << np.uint64(16)) | self._next(np.arange(len(starts)))

    def _next(self, rows: np.ndarray) -> np.ndarray:
        found = self.words[np.minimum(self.at[rows], len(self.words) - 1)]
        self.at[rows] += 1
        return found

    def value(self, at, bits) -> np.ndarray:
        found = (self.code[at] - self.low[at]) // (self.span[at] >> bits)
        return np.minimum(found, (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)

    def shift(self, at: np.ndarray) -> None:
        self.code[at] = (self.code[at] << np.uint64(16)) | self._next(at)


def _actives(sizes: np.ndarray):
    """How many blocks still have an id, step by step."""
    blocks = len(sizes)
    for step in range(int(sizes[0]) if blocks else 0):
        yield step, blocks if step < sizes[-1] else blocks - 1


def _checks(table: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(row[:n].astype("<u4").tobytes()) for row, n in zip(table, sizes)], "<u4")


def encode(ids: np.ndarray) -> bytes:
    """``ids`` (below 65,536) as blocks that are each coded from a fresh model and carry a checksum.

    Of each id one of three intervals is coded: the order-2 prediction, the order-1 prediction, or
    neither; their widths mix the hit rates seen so far. A miss is coded by its order-0 class and
    its place within the class.
    """
    table, sizes = _lay(np.asarray(ids))
    blocks = len(sizes)
    model, out = Model(blocks), _Writer(blocks)
    for step, active in _actives(sizes):
        now = np.ascontiguousarray(table[:active, step])
        end2, end1 = model.predict(active)
        hit2 = model.guess2 == now + 1
        hit1 = (model.guess1 == now + 1) & ~hit2
        start = np.where(hit2, 0, np.where(hit1, end2, end1))
        end = np.where(hit2, end2, np.where(hit1, end1, ONE))
        out.narrow(slice(active), start, end - start, np.uint64(SHARE))
        missed = np.flatnonzero(~(hit2 | hit1))
        if len(missed):
            bucket = BUCKET_OF.take(now[missed])
            low, high = model.ends[missed, bucket], model.ends[missed, bucket + 1]
            out.narrow(missed, low, high - low, np.uint64(SLOTS))
            out.narrow(missed, now[missed] - STARTS[bucket], None, WIDTHS[bucket])
        out.settle(active)
        model.update(active, now, hit2, hit1, missed)
    for k in range(4):
        out.words[np.arange(blocks), out.used] = (out.low >> np.uint64(48 - 16 * k)) & np.uint64(0xFFFF)
        out.used += 1
    streams = [out.words[i, :n].astype("<u2").tobytes() for i, n in enumerate(out.used)]
    head = struct.pack("<4sII", MAGIC, BLOCK, len(ids))
    return b"".join([head, out.used.astype("<u4").tobytes(), _checks(table, sizes).tobytes(), *streams])


def decode(data: bytes) -> np.ndarray:
    """The ids of an encoded text; a damaged block is an error that names it."""
    magic, block, total = struct.unpack_from("<4sII", data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a file of this format")
    blocks = -(-total // BLOCK)
    at = struct.calcsize("<4sII")
    used = np.frombuffer(data, "<u4", blocks, at).astype(np.int64)
    checks = np.frombuffer(data, "<u4", blocks, at + 4 * blocks)
    words = np.frombuffer(data, "<u2", -1, at + 8 * blocks)
    table, sizes = _lay(np.zeros(total, np.int64))
    model, source = Model(blocks), _Reader(words, np.concatenate(([0], np.cumsum(used[:-1]))) if blocks else used)
    for step, active in _actives(sizes):
        end2, end1 = model.predict(active)
        value = source.value(slice(active), np.uint64(SHARE))
        hit2 = value < end2
        hit1 = ~hit2 & (value < end1)
        start = np.where(hit2, 0, np.where(hit1, end2, end1))
        end = np.where(hit2, end2, np.where(hit1, end1, ONE))
        now = np.where(hit2, model.guess2, model.guess1) - 1
        source.narrow(slice(active), start, end - start, np.uint64(SHARE))
        missed = np.flatnonzero(~(hit2 | hit1))
        if len(missed):
            slot = source.value(missed, np.uint64(SLOTS))
            bucket = np.searchsorted(model.flat_ends, slot + (missed << SLOTS), "right") - missed * BUCKETS
            low, high = model.ends[missed, bucket], model.ends[missed, bucket + 1]
            source.narrow(missed, low, high - low, np.uint64(SLOTS))
            place = source.value(missed, WIDTHS[bucket])
            source.narrow(missed, place, None, WIDTHS[bucket])
            now[missed] = STARTS[bucket] + place
        source.settle(active)
        table[:active, step] = now
        model.update(active, now, hit2, hit1, missed)
    wrong = np.flatnonzero(_checks(table, sizes) != checks)
    if len(wrong):
        raise ValueError(f"block {wrong[0]} is damaged")
    return table.reshape(-1)[:total]
