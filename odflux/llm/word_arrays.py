"""Words of many texts as flat numpy arrays: places in one byte buffer, 64-bit hashes, shingle sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Odd constants of well-mixed bits.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_1
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX_2
    return values ^ (values >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of a list of texts, in order: byte places in ``buffer`` and the first word of each text in ``first``."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word, equal for equal bytes."""
        return span_hashes(self.buffer, self.starts, self.ends)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, unpower = _power_tables(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * unpower[starts] + (ends - starts).astype(np.uint64) * _STEP)


def split_words(texts: list[str | None], lower: bool = True, gap: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes that are no ``gap``; the given gaps are ASCII, so letters stay whole. Null is empty."""
    raw = [t.encode() if t else b"" for t in texts]
    buffer = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    if lower:
        buffer = LOWER[buffer]
    edge = np.diff(np.concatenate([[0], (~gap[buffer]).view(np.int8)]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    return Words(buffer, starts, ends, np.searchsorted(starts, begins))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``width`` words that lies in one text, first run of each text).

    A text of fewer words, one at least, has a single run: all its words.
    """
    sizes = np.diff(first)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    rolled = np.zeros(n, dtype=np.uint64)
    short = np.zeros(n, dtype=np.uint64)
    left = np.repeat(first[1:], sizes) - np.arange(n)  # words from here to the text's end
    small = np.repeat(sizes < width, sizes)
    for k in range(width):
        moved = np.zeros(n, dtype=np.uint64)
        moved[:n - k] = hashes[k:]
        rolled = rolled * _STEP + moved
        short = np.where(left > k, short * _STEP + moved + np.uint64(1), short)
    begin = np.zeros(n, dtype=bool)
    begin[first[:-1][sizes > 0]] = True
    keep = (left >= width) | (small & begin)
    found = mix(np.where(small, short, rolled))[keep]
    runs = np.where(sizes >= width, sizes - width + 1, (sizes > 0).astype(np.int64))
    return found, np.concatenate([[0], np.cumsum(runs)])


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = split_words(texts)
    found, first = windows(words.hashes(), words.first, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        one = np.sort(found[a:b])
        if len(one) > 1:
            one = one[np.concatenate([[True], one[1:] != one[:-1]])]
        out.append(one)
    return out


def set_id(members: np.ndarray) -> int:
    """64-bit id of a sorted set, as a signed integer; the empty set has 0."""
    if not len(members):
        return 0
    seed = np.array([len(members) * int(_STEP) & (1 << 64) - 1], dtype=np.uint64)
    value = int(mix(mix(members).sum(dtype=np.uint64, keepdims=True) + seed)[0])
    return value - (1 << 64) if value >> 63 else value
