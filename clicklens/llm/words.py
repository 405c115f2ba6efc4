"""Words of an Arrow text column as numpy arrays, a bounded block of rows at a time.

Used inside ``mapInArrow`` tasks only. A block holds whole rows of about ``BLOCK`` bytes (one longer
text is a block of its own), so the arrays made from it stay small however large the Arrow batch is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2**64
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = 0xD6E8FEB86659FD93              # odd base of the window hash


class _Tables(dict):
    """Tables that a process makes for itself; they do not travel with a job."""

    def __reduce__(self):
        return _Tables, ()


_powers = _Tables()


def byte_table(is_word) -> np.ndarray:
    """256 booleans: which bytes belong to words."""
    return np.array([bool(is_word(b)) for b in range(256)])


#: words ``[^\x20\x09-\x0D]+``
NOT_BLANK = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: after A-Z are lower-cased: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_LOWER = np.frombuffer(LOWER, dtype=np.uint8)


@dataclass
class Words:
    """Words of rows ``first .. first + rows - 1`` of a batch; ``starts``/``ends`` are byte positions in ``buf``."""
    first: int
    rows: int
    buf: np.ndarray
    offsets: np.ndarray     # byte position of each row in ``buf``; one more at the end
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray         # row of each word, counted from 0 in this block
    hashed: np.ndarray | None = None

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self) -> np.ndarray:
        if self.hashed is None:
            self.hashed = word_hashes(self.buf, self.starts, self.ends)
        return self.hashed

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(all words joined by one blank each, start and end of each word in it): equal runs of words are equal bytes."""
        size = self.ends - self.starts
        begin = np.cumsum(size + 1) - (size + 1)
        out = np.full(int((size + 1).sum()), 0x20, dtype=np.uint8)
        move = np.repeat(begin - self.starts, size)     # how far each byte of a word goes
        at = np.arange(len(move)) + np.repeat(self.starts - (np.cumsum(size) - size), size)
        out[at + move] = self.buf[at]
        return out.tobytes(), begin, begin + size

    def first_word(self) -> np.ndarray:
        """Index of each row's first word; one more at the end."""
        return np.concatenate(([0], np.cumsum(self.counts())))


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        t = np.full(max(n, BLOCK + 64), base, dtype=np.uint64)
        t[0] = 1
        have = _powers[name] = np.cumprod(t, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes from prefix sums, in bounded stretches of the buffer."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, side="right")))
        seg = buf[lo:int(ends[j - 1])]
        pw = _power_table("p", _P, len(seg) + 1)
        ip = _power_table("i", _P_INV, len(seg) + 1)
        pref = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum((seg.astype(np.uint64) + _U(1)) * pw[:len(seg)], out=pref[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((pref[e] - pref[s]) * ip[s] + (e - s).astype(np.uint64))
        i = j
    return out


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries of ``h`` (``len(h) - n + 1`` of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        acc += h[j:j + m] * _U(pow(_Q, j + 1, 1 << 64))
    return mix(acc)


def _as_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(data bytes, row offsets) of a text column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_large_string(col.type) or pa.types.is_string(col.type)):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    if off is None or len(col) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offsets.astype(np.int64)


def word_blocks(col, table: np.ndarray = NOT_BLANK, lower: bool = False) -> Iterator[Words]:
    """The words of a text column, block after block."""
    raw, offsets = _as_bytes(col)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK, side="right")) - 1)
        buf = raw[offsets[a]:offsets[b]]
        if lower:
            buf = _LOWER[buf]
        off = offsets[a:b + 1] - offsets[a]
        inside = table[buf]
        edge = np.zeros(len(buf) + 1, dtype=bool)
        edge[off] = True
        before = np.empty(len(buf), dtype=bool)
        after = np.empty(len(buf), dtype=bool)
        if len(buf):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        row = np.searchsorted(off, starts, side="right") - 1
        yield Words(a, b - a, buf, off, starts, ends, row)
        a = b
