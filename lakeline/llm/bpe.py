"""Byte-level BPE by speculation and verification.

The tokens of a word are guessed by greedy longest match. A guess is right if and only if each token is
what its own bytes merge to and each two neighbours are compatible: undoing the latest merge of the
two over and over, their touching parts must never have been mergeable earlier than the merge that
replaced one of them. These checks run on arrays, over all pairs of a batch of words at once. Only words
with a pair that fails are merged exactly, one merge at a time.

Decoding joins the bytes of the ids and replaces invalid UTF-8. Null text is empty; special tokens' strings
in a text are encoded as their id, as the tokenizer file says.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeline.llm.pieces import Coder, worker_memo
from lakeline.llm.words import slices
from lakeline.sources.files import table

SHORT = 48


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + n): byte for n, byte in enumerate(hidden)}


class Vocabulary:
    """Tokens in merge order: 256 bytes, then one token for each merge. ``ids`` maps to file ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        code = spec["model"]["vocab"]
        spell = {token: bytes(letters[c] for c in token) for token in code}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        special = spec["added_tokens"][0]
        self.special, self.special_id = special["content"], special["id"]
        names = [chr_ for chr_, byte in sorted(letters.items(), key=lambda item: item[1])]
        rank = {name: n for n, name in enumerate(names)}
        left, right = [], []
        for number, (a, b) in enumerate(merges):
            left.append(rank[a])
            right.append(rank[b])
            rank[a + b] = 256 + number
            names.append(a + b)
        self.left = np.concatenate((np.arange(256), left)).astype(np.int64)
        self.right = np.concatenate((np.arange(256), right)).astype(np.int64)
        self.size = len(names)
        self.ids = [code[name] for name in names]
        self.bytes = [spell[name] for name in names]
        self.tree: dict = {}
        for number, token in enumerate(self.bytes):
            node = self.tree
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = number
        self.pairs = {a * self.size + b: 256 + n for n, (a, b) in enumerate(zip(left, right))}
        keys = self.left[256:] * self.size + self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order + 256
        size = max(max(code.values()), self.special_id) + 1
        self.spelled = [b""] * size
        for name, number in code.items():
            self.spelled[number] = spell[name]
        self.spelled[self.special_id] = self.special.encode()
        self.whole = self._whole()

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``size`` where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.size)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Could ``a`` and ``b`` stand side by side until merge number ``before``?

        The later of the two tokens' last merges is undone first; of equal merges the right one is
        later. A touching pair must not have had a merge that comes before the one just undone; a
        merge of equal rank in the left neighbour comes first, in the right one it comes after.
        """
        a, b, limit = a.copy(), b.copy(), before.copy()
        good = np.ones(len(a), bool)
        alive = np.arange(len(a))
        while len(alive):
            x, y = a[alive], b[alive]
            bad = self._merged(x, y) < limit[alive]
            good[alive[bad]] = False
            undo_left = x > y
            base = np.where(undo_left, x, y) < 256
            on = ~bad & ~base
            alive, x, y, undo_left = alive[on], x[on], y[on], undo_left[on]
            limit[alive] = np.where(undo_left, x, y + 1)
            a[alive] = np.where(undo_left, self.right[x], x)
            b[alive] = np.where(undo_left, y, self.left[y])
        return good

    def _whole(self) -> np.ndarray:
        """Which tokens are what their own bytes merge to."""
        good = np.ones(self.size, bool)
        ranks = np.arange(256, self.size)
        good[256:] = self.compatible(self.left[256:], self.right[256:], ranks)
        for rank in ranks[~(good[self.left[256:]] & good[self.right[256:]])]:
            good[rank] &= good[self.left[rank]] and good[self.right[rank]]
        return good

    def guess(self, word: bytes) -> list[int]:
        """Greedy longest match, along a tree of the tokens' bytes."""
        tree, found, start, length = self.tree, [], 0, len(word)
        while start < length:
            node, at, token, stop = tree, start, -1, start
            while at < length and (node := node.get(word[at])) is not None:
                at += 1
                if -1 in node:
                    token, stop = node[-1], at
            found.append(token)
            start = stop
        return found

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, of equal ranks the leftmost."""
        return self._merge_short(word) if len(word) <= SHORT else self._merge_long(word)

    def _merge_short(self, word: bytes) -> list[int]:
        size, rank_of = self.size, self.pairs.get
        parts = list(word)
        ranks = [rank_of(a * size + b, size) for a, b in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) < size:
            at = ranks.index(rank)
            parts[at:at + 2] = [rank]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] * size + rank, size)
            if at < len(ranks):
                ranks[at] = rank_of(rank * size + parts[at + 1], size)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        size, rank_of = self.size, self.pairs.get
        parts = list(word)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue = [(rank, at, parts[at], parts[at + 1]) for at in range(len(parts) - 1)
                 if (rank := rank_of(parts[at] * size + parts[at + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, at, a, b = heapq.heappop(queue)
            follow = after[at]
            if parts[at] != a or follow >= len(parts) or parts[follow] != b:
                continue
            parts[at], parts[follow] = rank, -1
            after[at] = after[follow]
            if after[at] < len(parts):
                before[after[at]] = at
                if (new := rank_of(rank * size + parts[after[at]])) is not None:
                    heapq.heappush(queue, (new, at, rank, parts[after[at]]))
            if before[at] >= 0 and (new := rank_of(parts[before[at]] * size + rank)) is not None:
                heapq.heappush(queue, (new, before[at], parts[before[at]], rank))
        return [part for part in parts if part >= 0]

    def words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Tokens of each word, and how many words had to be merged exactly."""
        guesses = [self.guess(word) for word in words]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((token for guess in guesses for token in guess), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        wrong = np.zeros(len(words), bool)
        wrong[owner[~self.whole[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size, np.full(len(pairs), self.size + 1))
        wrong[owner[inner[~good[where]]]] = True
        for number in np.flatnonzero(wrong):
            guesses[number] = self.merge(words[number])
        return guesses, int(wrong.sum())

    def encode(self, words: list[str]) -> list[list[int]]:
        """File ids of each word."""
        tokens, _ = self.words([word.encode() for word in words])
        ids = self.ids
        return [[ids[token] for token in word] for word in tokens]

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.spell(ids).decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of ``path``, built once in each worker."""
    built = worker_memo("vocabularies")
    if path not in built:
        built[path] = Vocabulary(path)
    return built[path]


#: What a task remembers of its words; a worker keeps the memory after the task.
MEMO_ENTRIES = 400_000

_CODED = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()),
])
_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
    ("decoded_sha256", pa.string()),
])


def _shown(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _coded(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        coder = Coder(None, known.special, known.special_id, known.encode, _shown, known.spell, entries=MEMO_ENTRIES)
        shown, spelled = (view.__getitem__ for view in coder.known)
        for batch in batches:
            for part in slices(batch, "text"):
                words = coder.words([text or "" for text in part.column("text").to_pylist()])
                listed = [",".join(map(shown, text)) for text in words]
                decoded = [b"".join(map(spelled, text)).decode("utf-8", "replace") for text in words]
                doc_ids = part.column("doc_id")
                if not digests:
                    ids = pa.array([[*map(int, filter(None, text.split(",")))] for text in listed], _CODED.field(1).type)
                    yield pa.RecordBatch.from_arrays([doc_ids, ids, pa.array(decoded, pa.string())], schema=_CODED)
                    continue
                yield pa.RecordBatch.from_arrays([
                    doc_ids, pa.array([text.count(",") + 1 if text else 0 for text in listed], pa.int64()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in listed]),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in decoded]),
                ], schema=_DIGESTS)

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: ids of every whole text, and the text they decode to."""
    return _texts(docs).mapInArrow(
        _coded(path or tokenizer_path(), False), "doc_id bigint, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text."""
    return _texts(docs).mapInArrow(
        _coded(path or tokenizer_path(), True),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of every document."""
    return encode_digests(table(spark, folder, "documents", "doc_id", "text"))
