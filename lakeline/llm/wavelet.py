"""Token ids in wavelet-matrix files, one per shard.

A shard holds the ids of consecutive documents as bit planes, from the highest bit down. Behind each
plane the ids are parted, stably, by its bit. With the ranks of each plane the file gives the token
at a place, the count of a token before a place, and the place of its n-th occurrence, without the ids
themselves. Planes and document table are Zstandard frames.

File: ``LKWM``, then seven little-endian 64-bit numbers (documents, tokens, planes and the four
sizes below), the document ids, their lengths, the zeros of each plane, all packed planes.
Ids in ascending order; a document that shares its id with another comes in the order of
their texts; a null id comes first. Null text is empty; each document ends with id 0.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.llm.bpe import tokenizer_path
from lakeline.llm.files import new_name, reading, writing
from lakeline.llm.pieces import Coder, worker_memo
from lakeline.llm.words import slices
from lakeline.session import stored, work_folder
from lakeline.sources.files import table

SHARD_TOKENS = 1 << 22
END = 0
MAGIC = b"LKWM"
NO_ID = -(2**63)


class WaveletMatrix:
    """Ids as bit planes. ``planes`` are packed bits, ``zeros`` the number of zero bits of each."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int]):
        self.size, self.planes, self.zeros = size, planes, zeros
        self._ranks: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        high = int(ids.max(initial=0))
        values = ids.astype(np.uint16 if high < 1 << 16 else np.uint32)
        planes, zeros = [], []
        for bit in range(max(1, high.bit_length()) - 1, -1, -1):
            ones = values & values.dtype.type(1 << bit) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            # by places: several times faster than by a mask
            values = np.concatenate((values.take(np.flatnonzero(~ones)), values.take(np.flatnonzero(ones))))
            zeros.append(len(ones) - int(np.count_nonzero(ones)))
        return cls(len(ids), planes, zeros)

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.planes[plane], count=self.size, bitorder="little").astype(bool)

    def ids(self) -> np.ndarray:
        """All ids, by undoing the partings from the last plane up."""
        values = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for plane in range(len(self.planes) - 1, -1, -1):
            ones, split = self._bits(plane), self.zeros[plane]
            above = np.empty_like(values)
            above[np.flatnonzero(~ones)] = values[:split]
            above[np.flatnonzero(ones)] = values[split:] | values.dtype.type(1 << (len(self.planes) - 1 - plane))
            values = above
        return values

    def _rank(self, plane: int, place: int) -> int:
        """Ones of a plane before a place: whole bytes from a directory, then the rest."""
        if plane not in self._ranks:
            counts = np.bitwise_count(self.planes[plane]).astype(np.int64)
            self._ranks[plane] = np.concatenate(([0], np.cumsum(counts)))
        whole, rest = divmod(place, 8)
        ones = int(self._ranks[plane][whole])
        return ones + (int(self.planes[plane][whole]) & ((1 << rest) - 1)).bit_count() if rest else ones

    def _bit(self, plane: int, place: int) -> int:
        return int(self.planes[plane][place >> 3]) >> (place & 7) & 1

    def access(self, place: int) -> int:
        """The token at a place."""
        token = 0
        for plane, zeros in enumerate(self.zeros):
            bit, ones = self._bit(plane, place), self._rank(plane, place)
            token = token * 2 + bit
            place = zeros + ones if bit else place - ones
        return token

    def _range(self, token: int, place: int) -> tuple[int, int]:
        low, high = 0, place
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            below, above = self._rank(plane, low), self._rank(plane, high)
            if token >> (len(self.planes) - 1 - plane) & 1:
                low, high = zeros + below, zeros + above
            else:
                low, high = low - below, high - above
        return low, high

    def count(self, token: int, place: int | None = None) -> int:
        """Occurrences of a token, before a place if one is given."""
        low, high = self._range(token, self.size if place is None else place)
        return high - low

    def select(self, token: int, number: int) -> int:
        """Place of the ``number``-th occurrence (from 0) of a token."""
        low, high = self._range(token, self.size)
        if not 0 <= number < high - low:
            raise IndexError(number)
        place = low + number
        for plane in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - plane) & 1
            place = self._select_bit(plane, bit, place - (self.zeros[plane] if bit else 0))
        return place

    def _select_bit(self, plane: int, bit: int, number: int) -> int:
        self._rank(plane, 0)
        ranks = self._ranks[plane]
        before = ranks if bit else np.arange(len(ranks)) * 8 - ranks
        byte = int(np.searchsorted(before, number, side="right")) - 1
        left = number - int(before[byte])
        for rest in range(8):
            if int(self.planes[plane][byte]) >> rest & 1 == bit:
                if not left:
                    return byte * 8 + rest
                left -= 1
        raise IndexError(number)

    def places(self, token: int) -> list[int]:
        """All places of a token, in order."""
        return [self.select(token, number) for number in range(self.count(token))]


def write_shard(path: str, doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> None:
    matrix = WaveletMatrix.build(ids)
    packer = zstandard.ZstdCompressor(level=1)
    parts = [packer.compress(part) for part in (
        np.array(doc_ids, np.int64).tobytes(), np.array(lengths, np.int64).tobytes(),
        np.array(matrix.zeros, np.int64).tobytes(), b"".join(plane.tobytes() for plane in matrix.planes))]
    with writing(path) as file:
        file.write(MAGIC + struct.pack("<7q", len(doc_ids), len(ids), len(matrix.planes), *map(len, parts)))
        for part in parts:
            file.write(part)


def read_shard(path: str) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, their lengths in tokens, and the matrix."""
    with reading(path) as file:
        data = file.read()
    if data[:4] != MAGIC:
        raise ValueError(f"not a shard: {path}")
    _, tokens, planes, *sizes = struct.unpack_from("<7q", data, 4)
    parts, at = [], 4 + 56
    for size in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at:at + size]))
        at += size
    doc_ids, lengths, zeros = (np.frombuffer(part, np.int64) for part in parts[:3])
    width = (tokens + 7) // 8
    bits = [np.frombuffer(parts[3], np.uint8, width, plane * width) for plane in range(planes)]
    return doc_ids, lengths, WaveletMatrix(tokens, bits, zeros.tolist())


def _library(path: str) -> tuple:
    """The tokenizer of ``path``, loaded once in each worker, its special token and that token's id."""
    loaded = worker_memo("tokenizers")
    if path not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = next(iter(tokenizer.get_added_tokens_decoder().items()))
        loaded[path] = tokenizer, special[1].content, special[0]
    return loaded[path]


_SHARDS = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("tokens", pa.int64()),
])


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _shards(path: str, folder: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, special, special_id = _library(path)
        coder = Coder(
            f"library {path}", special, special_id,
            lambda words: [code.ids for code in tokenizer.encode_batch_fast(words, add_special_tokens=False)],
            _packed)
        coded, end = coder.known[0].__getitem__, np.array([END], "<u4").tobytes()
        part, shard, held = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int] = []
        texts: list[bytes] = []

        def full() -> pa.RecordBatch:
            name = new_name(folder, "wm")
            lengths = [len(text) // 4 for text in texts]
            write_shard(name, doc_ids, lengths, np.frombuffer(b"".join(texts), "<u4"))
            row = [[part], [shard], [name], [sum(lengths)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(value, kind.type) for value, kind in zip(row, _SHARDS)], schema=_SHARDS)

        for batch in batches:
            for piece in slices(batch, "text"):
                words = coder.words([text or "" for text in piece.column("text").to_pylist()])
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), words):
                    doc_ids.append(NO_ID if doc_id is None else doc_id)
                    texts.append(b"".join(map(coded, text)) + end)
                    held += len(texts[-1]) // 4
                    if held >= shard_tokens:
                        yield full()
                        doc_ids, texts, held, shard = [], [], 0, shard + 1
        if doc_ids:
            yield full()

    return run


def write_tokens(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs (doc_id, text)`` as shards in ascending doc_id order; returns their manifest.

    ``part, shard, path, tokens, start``: a shard's tokens follow those of all shards before it. A
    shard is closed once it holds ``shard_tokens``, so it is larger only by its last document.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "tokens")
    texts = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = stored(ordered.mapInArrow(
        _shards(path or tokenizer_path(), folder, shard_tokens),
        "part int, shard int, path string, tokens bigint"), "shards")
    # one total for each partition of the job above
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect()
    starts, start = [], 0
    for row in totals:
        starts.append((row["part"], start))
        start += row["tokens"]
    bases = spark.createDataFrame(starts or [], "part int, base bigint")
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.join(bases, "part").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("tokens").over(before), F.lit(0))).drop("base")


_READ = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            doc_ids, lengths, matrix = read_shard(row["path"])
            data = memoryview(matrix.ids().astype("<u4").tobytes())
            ends = np.cumsum(lengths)
            starts = ends - lengths
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID), pa.array(starts + row["start"]),
                pa.array(lengths), pa.array(sums, pa.int64()),
            ], schema=_READ)


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the shards."""
    shards = manifest.select("path", "start").repartition(
        manifest.sparkSession.sparkContext.defaultParallelism * 2, "path")
    return shards.mapInArrow(_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    """Write all documents as token shards and read each one back."""
    return read_documents(write_tokens(table(spark, folder, "documents", "doc_id", "text")))
