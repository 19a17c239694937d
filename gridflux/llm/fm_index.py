"""An FM-index over the words of one shard of texts, in NumPy.

The sequence is every text's words, a separator after each text and an end mark, so no match reaches
over a text's edge. Symbols: 0 end mark, 1 separator, then the shard's words, each known by a 64-bit
hash. The suffix array comes from doubling: suffixes sorted by three symbols, then only those still
tied by the rank of what follows. Kept are the Burrows-Wheeler transform as a wavelet tree (one bit
vector for each level, in the level-wise form whose zeros go before its ones), and every
``SAMPLE``-th place of the sequence at the rows where the suffix array has it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; the last symbol must be the least and stand once."""
    n = len(symbols)
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    width = max(1, 63 // bits)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(width):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key)
    rank, tied = _ranks(key[order], order, np.arange(n), np.zeros(n, np.int64))
    depth = width
    while len(tied):
        at = order[tied]
        follow = rank[np.minimum(at + depth, n - 1)]  # a tied suffix is longer than its depth
        group = rank[at]
        by = np.argsort((group << np.int64(32)) | follow)  # ranks stay below 2^31
        order[tied] = at[by]
        rank, tied = _ranks(((group << np.int64(32)) | follow)[by], order, tied, rank)
        depth *= 2
    return order


def _ranks(keys: np.ndarray, order: np.ndarray, rows: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Give the suffixes in ``rows`` the row that begins their run of equal keys as rank; and the rows still tied."""
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(keys)))
    rank[order[rows]] = rows[np.repeat(heads, sizes)]
    return rank, rows[np.repeat(sizes > 1, sizes)]


class Bits:
    """A bit vector with the number of ones before each place."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32)

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        raw = np.packbits(bits, bitorder="little")
        return np.concatenate([raw, np.zeros(8 - len(raw) % 8, np.uint8)]).view("<u8")  # a spare word, for the place past the end

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


def depth(symbols: int) -> int:
    """Levels of the tree over so many symbols."""
    return max(1, (symbols - 1).bit_length())


@dataclass
class Index:
    """The stored parts, all arrays: the words' hashes ascending and their symbols, how many symbols are less than
    each, the levels' bits, rows with a sampled place and those places, and where each text begins."""

    n: int
    hashes: np.ndarray
    symbols: np.ndarray
    less: np.ndarray
    levels: np.ndarray
    sampled: np.ndarray
    places: np.ndarray
    starts: np.ndarray

    @staticmethod
    def build(hashes: np.ndarray, text: np.ndarray, texts: int) -> Index:
        """Of ``texts`` texts, whose words are ``hashes`` in order, each with the number of its text."""
        codes, words = pd.factorize(hashes)
        size = np.bincount(text, minlength=texts).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(size + 1)])
        sequence = np.ones(starts[-1] + 1, np.int32)
        sequence[np.arange(len(codes)) + text] = codes + 2
        sequence[-1] = 0
        order = suffix_array(sequence)
        bwt = sequence[order - 1]
        less = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=len(words) + 2))])
        levels = []
        for level in range(depth(len(words) + 2) - 1, -1, -1):
            bit = ((bwt >> level) & 1).astype(bool)
            levels.append(Bits.pack(bit))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        marks = order % SAMPLE == 0
        by = np.argsort(words)
        return Index(len(sequence), words[by], (by + 2).astype(np.int32), less.astype(np.int32), np.stack(levels), Bits.pack(marks), order[marks].astype(np.int32), starts.astype(np.int32))

    def __post_init__(self) -> None:
        self._bits, self._marks = [Bits(w) for w in self.levels], Bits(self.sampled)
        ones = [int(b.ones(np.array([self.n]))[0]) for b in self._bits]
        self._zeros = [self.n - k for k in ones]
        # below the last level a symbol's rows stand in the order of its bits read backwards
        count, symbol = np.diff(self.less), np.arange(len(self.less) - 1)
        backwards = np.zeros_like(symbol)
        for k in range(len(self.levels)):
            backwards |= ((symbol >> k) & 1) << (len(self.levels) - 1 - k)
        by = np.argsort(backwards)
        begin = np.zeros(len(count), np.int64)
        begin[by] = np.cumsum(count[by]) - count[by]
        self._shift = self.less[:-1] - begin

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """less(symbol) plus the number of symbols like it before the row: a backward step of a range's edge."""
        for k, (bits, zeros) in enumerate(zip(self._bits, self._zeros), 1):
            ones = bits.ones(row)
            row = np.where((symbol >> (len(self._bits) - k)) & 1, zeros + ones, row - ones)
        return row + self._shift[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one place earlier; the symbol is read on the way down."""
        symbol = np.zeros(len(row), np.int64)
        for bits, zeros in zip(self._bits, self._zeros):
            bit = bits.bit(row).astype(np.int64)
            ones = bits.ones(row)
            row = np.where(bit, zeros + ones, row - ones)
            symbol = symbol << 1 | bit
        return row + self._shift[symbol]

    def find(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and past row of each phrase that stands in the shard, and its number. ``phrases``: a row of
        hashes each, filled up on the left to one length."""
        width = phrases.shape[1]
        if not len(self.hashes):
            none = np.zeros(0, np.int64)
            return none, none, none
        live = np.arange(len(phrases))
        first, past = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        for k in range(width):
            over = k >= lengths[live]
            word = phrases[live, width - 1 - k]
            at = np.minimum(np.searchsorted(self.hashes, word), len(self.hashes) - 1)
            known = self.hashes[at] == word
            symbol = self.symbols[at].astype(np.int64)
            stepped = self.step(np.concatenate([symbol, symbol]), np.concatenate([first, past]))
            first, past = np.where(over, first, stepped[: len(live)]), np.where(over, past, stepped[len(live) :])
            kept = over | known & (first < past)
            live, first, past = live[kept], first[kept], past[kept]
        return first, past, live

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in ``rows``: steps back to a sampled place."""
        place, steps, at, left = np.zeros(len(rows), np.int64), 0, rows, np.arange(len(rows))
        while len(left):
            marked = self._marks.bit(at).astype(bool)
            place[left[marked]] = self.places[self._marks.ones(at[marked])] + steps
            at, left = at[~marked], left[~marked]
            at, steps = self.back(at), steps + 1
        return place


def occurrences(index: Index, phrases: np.ndarray, lengths: np.ndarray, most: int = 1 << 18):
    """phrase, text and word within the text of every occurrence, ``most`` rows of the index or one phrase's at a time."""
    first, past, number = index.find(phrases, lengths)
    size = past - first
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        many = size[at:to]
        which = np.repeat(np.arange(at, to), many)
        rows = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        place = index.locate(rows)
        text = np.searchsorted(index.starts, place, "right") - 1
        yield number[which], text, place - index.starts[text]
        at = to
