"""Word and window hashes of whole texts, computed on arrays rather than word by word.

A word is ``[^\\x20\\x09-\\x0D]+``. Every function takes any number of texts at once and keeps its
scratch memory near a few dozen times the bytes it is given, so callers cut their input with
``slices``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
LONG_WORD = 1 << 12

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ANY = np.random.default_rng(20240229)
_BYTES = _ANY.integers(1, 2**63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _ANY.integers(1, 2**63, (2, LONG_WORD), np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _ANY.integers(1, 2**63, (2, 64), np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def slices(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of text, or one longer text."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


class Words:
    """The words of many texts: byte places, hashes, and where each text begins.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``place`` is a word's number in its text.
    """

    def __init__(self, texts: list[bytes], seeds: int = 1):
        self.buffer = b"\n".join(texts) + b"\n"
        data = np.frombuffer(self.buffer, np.uint8)
        space = _SPACE[data]
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(data) and not space[0]:
            turns = np.concatenate(([0], turns))
        self.starts, self.ends = turns[0::2], turns[1::2]
        lengths = np.fromiter((len(text) for text in texts), np.int64, len(texts))
        borders = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.first = np.searchsorted(self.starts, borders).astype(np.int64)
        counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.place = np.arange(len(self.starts)) - np.repeat(self.first[:-1], counts)
        self.counts = counts
        self.left = np.repeat(counts, counts) - self.place
        self.hashes = [self._hash(data, space, seed) for seed in range(seeds)]

    def _hash(self, data: np.ndarray, space: np.ndarray, seed: int) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        begin = np.zeros(len(data), np.int64)
        begin[self.starts] = self.starts
        inside = np.arange(len(data)) - np.maximum.accumulate(begin)
        values = _BYTES[seed][data] * _PLACES[seed][np.minimum(inside, LONG_WORD - 1)]
        values[space] = 0
        hashes = np.add.reduceat(values, self.starts)
        for word in np.flatnonzero(lengths >= LONG_WORD):
            piece = self.buffer[self.starts[word]:self.ends[word]]
            digest = hashlib.blake2b(piece, digest_size=8, salt=bytes([seed])).digest()
            hashes[word] = np.frombuffer(digest, np.uint64)[0]
        return mixed(hashes)

    def windows(self, size: int, seed: int = 0) -> np.ndarray:
        """Hash of ``size`` words from each word on; only those with ``left >= size`` count."""
        words = self.hashes[seed]
        total = np.zeros(len(words), np.uint64)
        for step in range(min(size, len(words))):
            total[:len(words) - step] += words[step:] * _STEPS[seed][step]
        return mixed(total)

    def whole(self, seed: int = 0) -> np.ndarray:
        """Hash of each text's word sequence."""
        words = self.hashes[seed]
        turned = mixed(words + mixed(self.place.astype(np.uint64) + np.uint64(seed + 1)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(turned)))
        return mixed(sums[self.first[1:]] - sums[self.first[:-1]] + self.counts.astype(np.uint64))

    def bytes_of(self, word: int) -> bytes:
        return self.buffer[self.starts[word]:self.ends[word]]
