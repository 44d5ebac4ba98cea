"""Static range asymmetric numeral system over token ids, in independent blocks of interleaved lanes.

One frequency table, shared by all blocks, is scaled to 2**SCALE_BITS. A block deals its ids to LANES coder states in
turn (id k goes to lane k % LANES), so each step works on a row of lanes at once. Words of 32 bits leave the states;
a decoder reads them in the opposite order. Every CHECKPOINT rows the decoder's states and its place in the words are
kept, so that parts of a block can be decoded without the parts before them, and in parallel.

Block: magic, ids, lanes, rows between checkpoints, words; checkpoints (place in the words, states); words.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

LANES = 4096
CHECKPOINT = 128
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIIIQ")
_MAGIC = b"dlr1"
_32 = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Ids in ascending order with scaled frequencies that sum to 2**bits."""

    ids: np.ndarray
    freq: np.ndarray
    bits: int

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)


def scaled(ids: np.ndarray, counts: np.ndarray) -> Table:
    """A table from counts of at least 1: every id keeps a frequency of 1 or more, the sum is a power of two."""
    order = np.argsort(ids)
    ids, counts = np.asarray(ids)[order], np.asarray(counts, np.float64)[order]
    bits = max(SCALE_BITS, int(np.ceil(np.log2(max(2 * len(ids), 2)))))
    if not len(ids):
        return Table(np.zeros(0, np.int64), np.zeros(0, np.int64), bits)
    total = 1 << bits
    freq = np.maximum(1, np.floor(counts / counts.sum() * (total - len(ids))).astype(np.int64))
    freq[np.argmax(freq)] += total - freq.sum()
    return Table(ids.astype(np.int64), freq, bits)


class Coder:
    def __init__(self, table: Table):
        self.bits = np.uint64(table.bits)
        self.mask = np.uint64((1 << table.bits) - 1)
        self.ids = table.ids
        self.freq = table.freq.astype(np.uint64)
        self.start = table.starts
        top = int(table.ids[-1]) + 1 if len(table.ids) else 0
        self.place = np.full(top, -1, np.int64)
        self.place[table.ids] = np.arange(len(table.ids))
        self.slot = np.repeat(np.arange(len(table.ids), dtype=np.uint32), table.freq)

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        rows = -(-n // LANES)
        at = self.place[ids]
        if n and at.min() < 0:
            raise ValueError("an id is missing from the frequency table")
        freq, start = self.freq[at], self.start[at]
        limit = freq << (np.uint64(63) - self.bits)
        x, chunks, marks, words = np.full(LANES, LOW), [], {}, 0
        for r in range(rows - 1, -1, -1):
            a, b = r * LANES, min(n, (r + 1) * LANES)
            v, f = x[: b - a], freq[a:b]
            full = v >= limit[a:b]
            if full.any():
                out = v[full]
                chunks.append((out & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
                words += len(out)
                v = np.where(full, v >> _32, v)
            q = v // f
            x[: b - a] = (q << self.bits) + (v - q * f) + start[a:b]
            if r % CHECKPOINT == 0:
                marks[r // CHECKPOINT] = (words, x.copy())
        out = [_HEAD.pack(_MAGIC, n, LANES, CHECKPOINT, len(marks), words)]
        for k in range(len(marks)):
            out.append(struct.pack("<Q", words - marks[k][0]) + marks[k][1].astype("<u8").tobytes())
        # The encoder ran backwards: reversed as a whole, words stand in the order in which the decoder takes them.
        stream = np.concatenate(chunks)[::-1] if chunks else np.zeros(0, "<u4")
        return b"".join([*out, stream.tobytes()])

    def decode(self, data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of a block; `first` and `last` (excluded) choose spans between checkpoints."""
        magic, n, lanes, every, marks, words = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a block of this format")
        size = 8 + 8 * lanes
        stream = np.frombuffer(data, "<u4", words, _HEAD.size + marks * size).astype(np.uint64)
        last = marks if last is None else last
        parts = [self._span(data, stream, k, n, lanes, every, size) for k in range(first, last)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _span(self, data, stream, k, n, lanes, every, size):
        at = _HEAD.size + k * size
        (place,) = struct.unpack_from("<Q", data, at)
        x = np.frombuffer(data, "<u8", lanes, at + 8).astype(np.uint64)
        begin, end = k * every * lanes, min(n, (k + 1) * every * lanes)
        found = np.empty(end - begin, np.uint32)
        for a in range(begin, end, lanes):
            b = min(end, a + lanes)
            v = x[: b - a]
            low = v & self.mask
            s = self.slot[low]
            found[a - begin : b - begin] = s
            v = self.freq[s] * (v >> self.bits) + low - self.start[s]
            need = v < LOW
            if m := int(np.count_nonzero(need)):
                v[need] = (v[need] << _32) | stream[place : place + m]
                place += m
            x[: b - a] = v
        return self.ids[found]
