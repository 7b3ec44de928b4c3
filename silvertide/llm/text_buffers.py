"""Whole texts of Arrow batches as byte arrays, and the words in them, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is a piece of its own.
PIECE_BYTES = 1 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 truth values, true in the ranges given (ends included)."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Words [^\x20\x09-\x0D]+ as bytes of UTF-8.
NON_SPACE = ~byte_set((0x09, 0x0D), (0x20, 0x20))
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of texts whose A-Z are lower-cased.
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.large_string())
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most so many bytes of text (or a single row), their bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = buffers(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and how many words each row has; rows end words."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.diff(np.searchsorted(starts, offsets))


def joined_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space after each, and where each begins and ends there."""
    lengths = stops - starts
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(begins[-1], 0x20, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(begins[:-1], lengths) + within] = data[np.repeat(starts, lengths) + within]
    return out, begins[:-1], begins[:-1] + lengths


def strings(values: list[bytes] | list[str]) -> pa.Array:
    return pa.array(values, pa.string())


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Lower-cased words of several texts: hashes, the text that each belongs to, and their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.stops, self.counts = word_spans(self.data, offsets, is_word)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])
        if len(self.data):
            sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(self.data))[:-1], out=sums[1:])
            raw = (sums[self.stops] - sums[self.starts]) * _powers(_INVERSE, len(self.data))[self.starts]
            self.hashes = mixed(raw + (self.stops - self.starts).astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they lie in one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = self.hashes[:n].copy()
        for j in range(1, k):
            out = out * _STEP + self.hashes[j : n + j]
        return mixed(out), self.row[:n] == self.row[k - 1 :]

    def winnowed(self, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the k-grams that are the least of a window of so many words inside one text."""
        gram, _ = self.grams(k)
        wide, n = window - k + 1, len(self.hashes) - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), gram[:0]
        least = gram[:n].copy()
        for j in range(1, wide):
            np.minimum(least, gram[j : n + j], out=least)
        least[self.row[:n] != self.row[window - 1 :]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen = np.zeros(len(gram), bool)
        for j in range(wide):
            chosen[j : n + j] |= gram[j : n + j] == least
        at = np.flatnonzero(chosen)
        return at, gram[at]

    def same(self, i: int, other: Words, j: int, n: int) -> bool:
        """Whether n words from i on equal n words of other from j on, byte for byte."""
        own, _, _ = joined_words(self.data, self.starts[i : i + n], self.stops[i : i + n])
        its, _, _ = joined_words(other.data, other.starts[j : j + n], other.stops[j : j + n])
        return len(own) == len(its) and bool((own == its).all())
