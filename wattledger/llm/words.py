"""Words of many documents at once, as 64-bit numbers in numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Words are taken from UTF-8 bytes, so no text is decoded. Hashes depend on
the words alone: every task and every run makes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

#: Bytes of text that are hashed together; longer texts are taken whole, alone.
CHUNK_BYTES = 1 << 19


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of each 64-bit number (the finalizer of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _byte_codes(seed: int) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * (seed + 1)))
    codes[WHITE] = 0
    return codes


def _multiplier(seed: int) -> np.uint64:
    return mix(np.array([77 + seed], dtype=np.uint64))[0] | np.uint64(1)


class Words:
    """The words of a few documents.

    starts, ends: byte range of each word in data; first: index of each document's first
    word, with the number of words at its end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        solid = ~WHITE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begins[inner] = solid[inner]
        stops = np.zeros(len(data) + 1, dtype=bool)
        stops[1:] = solid
        stops[1:-1] &= ~solid[1:]
        stops[inner] = solid[inner - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops)
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def lower(self) -> Words:
        """The same words with A-Z in lower case."""
        data = self.data.copy()
        capital = (data >= 65) & (data <= 90)
        data[capital] += 32
        self.data = data
        return self

    def counts(self) -> np.ndarray:
        """Words per document."""
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        lead = self.starts[0]
        data = self.data[lead:]
        starts = self.starts - lead
        lengths = np.diff(starts, append=len(data))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        powers = np.full(lengths.max(), _multiplier(seed), dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.add.reduceat(_byte_codes(seed)[data] * powers[place], starts)
        return mix(sums + (self.ends - self.starts).astype(np.uint64))

    def document_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` words in a row. Those that cross a document's end are for the
    caller to leave out; there are none if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for place in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[place : place + count]
    return mix(total)


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every `size` values in a row."""
    covered = 1
    while covered * 2 <= size:
        values = np.minimum(values[:-covered], values[covered:])
        covered *= 2
    if covered < size:
        values = np.minimum(values[: len(values) - (size - covered)], values[size - covered :])
    return values


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words) for runs of rows of about CHUNK_BYTES.
    A null text has no words."""
    texts = texts.cast(pa.large_string())
    begin = texts.offset
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[begin : begin + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        part = data[offsets[row] : offsets[stop]]
        yield row, stop, Words(part, offsets[row : stop + 1] - offsets[row])
        row = stop
