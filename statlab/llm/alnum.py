"""Words of letters and digits in UTF-8 bytes, and the checksums of runs of them, without touching a word in Python."""

from __future__ import annotations

import zlib

import numpy as np

#: The same words as a pattern over code points: digits, a-z and all that is not ASCII, after lower-casing A-Z.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True
#: Up to so many bytes a word is taken byte by byte along with all others; a longer one by itself.
_LONG = 64


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words_of(lower: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in texts that lie end to end, and each text's first word (n + 1 places)."""
    inside = _INSIDE[lower]
    begin = np.zeros(len(lower) + 1, dtype=bool)  # places where a text begins break words too
    begin[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | begin[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | begin[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_STEP = _byte_table()


def _step(state: np.ndarray, byte) -> np.ndarray:
    return _STEP[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _apply(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map ``shift`` (one table per byte of the checksum) of every checksum."""
    out = shift[0][crc & 255]
    for b in range(1, 4):
        out = out ^ shift[b][(crc >> np.uint32(8 * b)) & 255]
    return out


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """What 0 to 64 zero bytes after a text do to its checksum; and 64, 128, 256 ... of them."""
    tables = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])]
    for _ in range(_LONG):
        tables.append(_step(tables[-1], np.uint32(0)))
    doubled = [tables[_LONG]]
    for _ in range(25):
        doubled.append(np.stack([_apply(doubled[-1], doubled[-1][b]) for b in range(4)]))
    return np.stack(tables), doubled


_SHIFT, _DOUBLED = _shift_tables()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksum of two texts in a row, from both checksums and the second's bytes."""
    rest = length & (_LONG - 1)
    out = _SHIFT[rest, 0, first & 255]
    for b in range(1, 4):
        out = out ^ _SHIFT[rest, b, (first >> np.uint32(8 * b)) & 255]
    large = np.flatnonzero(length >= _LONG)
    if len(large):
        held, times, k = out[large], length[large] >> 6, 0
        while (times >> k).any():
            held = np.where((times >> k) & 1, _apply(_DOUBLED[k], held), held).astype(np.uint32)
            k += 1
        out[large] = held
    return out ^ second


def word_crcs(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of every word."""
    length = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    short = np.flatnonzero(length <= _LONG)
    order = short[np.argsort(-length[short], kind="stable")]
    begin, longer = starts[order], len(order) - np.cumsum(np.bincount(length[order], minlength=_LONG + 1))
    state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(_LONG):
        n = int(longer[k])  # words of more than k bytes stand first
        if not n:
            break
        state[:n] = _step(state[:n], lower[begin[:n] + k])
    out[order] = ~state
    for i in np.flatnonzero(length > _LONG):
        out[i] = zlib.crc32(lower[starts[i]:ends[i]].tobytes())
    return out


def with_space(crc: np.ndarray) -> np.ndarray:
    """The checksum of a text and a space after it."""
    return ~_step(~crc, np.uint32(32))
