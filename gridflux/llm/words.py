"""Words of many whole texts at once, as 64-bit hashes in NumPy arrays.

Words are what Python's str.split() gives: runs of characters other than white space. A word's hash
is a polynomial over its UTF-8 bytes, each byte standing for a random 64-bit number, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridflux.llm.common import release

#: White space as str.split() takes it, for the SQL side and as code points (fixed values).
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SLICE_BYTES = 1 << 18

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WIDE_SPACE = {size: [c.encode() for c in SPACES if len(c.encode()) == size] for size in (2, 3)}
_BYTES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS = _INVERSE = np.ones(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    hash: np.ndarray  # of each word, in the order of the texts
    text: np.ndarray  # which text it stands in
    line: np.ndarray  # and in which of its lines, cut at \n


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2^64, from 0 to ``n - 1`` at least."""
    global _POWERS, _INVERSE
    if n > len(_POWERS):
        rows = [np.full(max(SLICE_BYTES + 1, n), x) for x in (_A, np.uint64(pow(int(_A), -1, 2**64)))]
        for x in rows:
            x[0] = 1
        _POWERS, _INVERSE = map(np.cumprod, rows)
    return _POWERS, _INVERSE


def _white(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a white-space character."""
    white = (data - np.uint8(9) < 5) | (data - np.uint8(28) < 5)  # U+0009 to U+000D, U+001C to U+0020
    for size, characters in _WIDE_SPACE.items():
        for lead in {c[0] for c in characters}:
            at = np.flatnonzero(data[: len(data) - size + 1] == lead)
            if not at.size:
                continue
            rest = sum(data[at + k].astype(np.int64) << (8 * k) for k in range(1, size))
            known = [sum(c[k] << (8 * k) for k in range(1, size)) for c in characters if c[0] == lead]
            at = at[np.isin(rest, known)]
            for k in range(size):
                white[at + k] = True
    return white


def split_words(texts: pa.Array) -> Words:
    """The words of an Arrow array of strings; nulls have none."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, raw = texts.buffers()
    edge = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    none = np.zeros(0, np.int64)
    if raw is None or not len(texts) or edge[0] == edge[-1]:
        return Words(none.astype(np.uint64), none, none)
    data = np.frombuffer(raw, np.uint8)[edge[0] : edge[-1]]
    edge = edge - edge[0]
    white = _white(data)
    before, after = np.empty_like(white), np.empty_like(white)
    before[0], before[1:] = True, white[:-1]
    before[edge[:-1][edge[:-1] < len(data)]] = True  # a text's first byte begins a word
    after[-1], after[:-1] = True, white[1:]
    after[edge[1:][edge[1:] > 0] - 1] = True
    start, end = np.flatnonzero(~white & before), np.flatnonzero(~white & after) + 1
    if not start.size:
        return Words(none.astype(np.uint64), none, none)
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES.take(data) * powers[: len(data)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _C)
    breaks = np.flatnonzero(data == 10)
    text = _passed(edge[1:], start)
    line = _passed(breaks, start) - np.searchsorted(breaks, edge[:-1])[text]
    return Words(h, text, line)


def _passed(marks: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of the sorted marks stand at or before each of the sorted starts; marks are the fewer."""
    return np.cumsum(np.bincount(np.searchsorted(start, marks), minlength=len(start) + 1))[:-1]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``most`` bytes of text, so memory follows neither
    the number of rows nor their length; one text is never cut."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(batch[column]).fill_null(0)).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to
    release()
