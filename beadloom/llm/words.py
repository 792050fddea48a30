"""Words of many texts at once as numpy arrays: boundaries, 64-bit hashes, and a hash index from words to rows."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)
_ONE = np.uint64(1)

#: Classes of bytes: white space, letter, digit, other sign.
SPACE, LETTER, DIGIT, SIGN = 0, 1, 2, 3

_CLASS = np.full(256, SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[128:] = LETTER


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.ones(1 << bits, np.uint64)
        for k in range(bits):  # doubling: out[n : 2n] = out[:n] * base^n
            np.multiply(out[: 1 << k], np.uint64(pow(base, 1 << k, 1 << 64)), out=out[1 << k : 2 << k])
        return out

    return table(_P), table(_INVERSE)


def forget() -> None:
    """Drops the tables that are kept between calls."""
    _powers.cache_clear()


def _bits(n: int) -> int:
    return max(20, int(n).bit_length())


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One array of all bytes with a space after each text, and where each text begins; the last is the end."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b" ".join([*texts, b""]), np.uint8), starts


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last element is False."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[::2], edge[1::2]


def space_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes other than ASCII white space."""
    return spans(_CLASS[data] != SPACE)


def letter_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters: ASCII letters and all characters from U+00C0 on but signs of U+2000-U+206F and U+3000-U+303F."""
    letter = _CLASS[data] == LETTER
    if (data >= 128).any():
        nxt = np.append(data[1:], np.uint8(32))
        for bad, width in (
            (data == 0xC2, 2),
            ((data == 0xC3) & ((nxt == 0x97) | (nxt == 0xB7)), 2),
            ((data == 0xE2) & ((nxt == 0x80) | (nxt == 0x81)), 3),
            ((data == 0xE3) & (nxt == 0x80), 3),
        ):
            at = np.flatnonzero(bad)
            for k in range(width):
                letter[np.minimum(at + k, letter.size - 1)] = False
    return spans(letter)


def class_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one class (letters, digits, other signs) without white space.

    No cut touches an apostrophe or a character outside ASCII but the letters U+00C0-U+00FF, so those stay in the run
    of their neighbours.
    """
    kind = _CLASS[data]
    inside = kind != SPACE
    cut = (kind[1:] != kind[:-1]) & inside[1:] & inside[:-1]
    if cut.any():
        firm = data < 128
        firm[data == 39] = False
        nxt = np.append(data[1:], np.uint8(32))
        lead = (data == 0xC3) & (nxt != 0x97) & (nxt != 0xB7)
        firm |= lead
        firm[1:] |= lead[:-1]
        cut &= firm[1:] & firm[:-1]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut
    end = np.zeros(data.size, bool)
    end[1:] = inside[:-1] & (~inside[1:] | cut)
    return np.flatnonzero(start), np.flatnonzero(end)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes, never 0."""
    if not starts.size:
        return np.empty(0, np.uint64)
    power, inverse = _powers(_bits(data.size))
    total = np.empty(data.size + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + _ONE) * power[: data.size], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.where(h == 0, _ONE, h)


class Index:
    """An open-addressing map from non-zero 64-bit hashes to the numbers 0, 1, 2 ... in order of their coming."""

    def __init__(self, bits: int = 16):
        self.bits, self.size = bits, 0
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash; -1 for unknown ones."""
        out = np.full(h.size, -1, np.int64)
        mask, left = (1 << self.bits) - 1, np.arange(h.size)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while left.size:
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.rows[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & mask
        return out

    def add(self, h: np.ndarray) -> None:
        """Numbers distinct unknown hashes."""
        while (self.size + h.size) * 2 > 1 << self.bits:
            keep = self.keys != 0
            keys, rows = self.keys[keep], self.rows[keep]
            self.bits += 1
            self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            self._put(keys, rows)
        self._put(h, np.arange(self.size, self.size + h.size, dtype=np.int32))
        self.size += h.size

    def _put(self, h: np.ndarray, rows: np.ndarray) -> None:
        mask, slot = (1 << self.bits) - 1, (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while h.size:
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            won = self.keys[slot] == h
            self.rows[slot[won]] = rows[won]
            h, rows, slot = h[~won], rows[~won], (slot[~won] + 1) & mask


def resolve(index: Index, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, new) -> np.ndarray:
    """The number of each run; new(list of bytes) is told the runs that get the next numbers, in their order."""
    h = hashes(data, starts, ends)
    rows = index.find(h)
    miss = np.flatnonzero(rows < 0)
    if miss.size:
        fresh, first = np.unique(h[miss], return_index=True)
        at = miss[first]
        raw = data.tobytes()
        new([raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        index.add(fresh)
        rows[miss] = index.find(h[miss])
    return rows


def gathered(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[offsets[r] : offsets[r + 1]] for each r of rows, joined; and the end of each in the joined array."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if ends.size else 0
    at = np.repeat(offsets[rows] - (ends - sizes), sizes) + np.arange(total)
    return flat[at], ends
