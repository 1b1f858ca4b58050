"""Words of many texts at once: places and 64-bit hashes as numpy arrays.

Works on the bytes of an Arrow string column, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once: bounds the memory of a task.
CHUNK_BYTES = 4 << 20


def _letters() -> np.ndarray:
    """A fixed random 64-bit number per byte value, by splitmix64."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


# What counts as part of a word.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text begins (and the last ends). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """Words of the texts of one column, in order.

    ``starts`` and ``ends`` are byte places in ``data``; the words of text i are
    ``bounds[i]`` to ``bounds[i + 1]``; ``texts`` has where the texts begin.
    """

    def __init__(self, texts: pa.Array | tuple[np.ndarray, np.ndarray], inside: np.ndarray = NOT_BLANK, lower: bool = False):
        self.data, self.texts = texts if isinstance(texts, tuple) else flat(texts)
        if lower:
            self.data = LOWER[self.data]
        flags = inside[self.data]
        n = len(flags)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            before[1:], after[:-1] = flags[:-1], flags[1:]
            edges = self.texts[(self.texts > 0) & (self.texts < n)]
            before[edges] = False
            after[edges - 1] = False
        self.starts = np.flatnonzero(flags & ~before)
        self.ends = np.flatnonzero(flags & ~after) + 1
        self.bounds = np.searchsorted(self.starts, self.texts)
        self.flags = flags

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """The number of its text for each word."""
        return np.repeat(np.arange(len(self.texts) - 1), self.counts)

    def hashes(self, salt: int = 0) -> np.ndarray:
        """A 64-bit polynomial hash of each word's bytes, finalised."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            spans = np.diff(np.append(self.starts, len(self.data)))
            place = np.arange(self.starts[0], len(self.data)) - np.repeat(self.starts, spans)
            factor = np.uint64(0xD1342543DE82EF95 + 2 * salt)
            powers = np.cumprod(np.full(int((self.ends - self.starts).max()) + 1, factor, np.uint64))
            place[place >= len(powers)] = 0  # between words, where nothing counts
            values = np.where(self.flags[self.starts[0]:], _LETTERS[self.data[self.starts[0]:]], np.uint64(0)) * powers[place]
            return mix(np.add.reduceat(values, self.starts - self.starts[0]) + np.uint64(salt))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` consecutive word hashes from each place on that has so
    many left, put together from runs of 1, 2, 4, ... words."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    factor, done, out, run, left = 0x9FB21C651E98DF25, 0, None, 1, size
    part = hashes
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(factor, run, 2**64))
            if left & run:
                n = len(part) - done
                out = part if out is None else out[:n] * power + part[done:]
                done += run
                left -= run
            if not left:
                return mix(out[:len(hashes) - size + 1])
            part = part[:-run] * power + part[run:]
            run *= 2


def slide_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of ``size`` consecutive values from each place on."""
    run, part = 1, values
    while 2 * run <= size:
        part = np.minimum(part[:-run], part[run:])
        run *= 2
    return np.minimum(part[:len(values) - size + 1], part[size - run:])


_LETTERS = _letters()
