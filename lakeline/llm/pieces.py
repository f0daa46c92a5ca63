"""Cutting texts into the words that byte-level BPE merges within, and a memo of their ids.

The pattern is the one the tokenizer file states. Texts of Latin letters are cut by an equal
pattern of the faster standard library; others by the original.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable

import regex

PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN = re.compile(
    rf" ?[{_LETTERS}]++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?[^\s{_LETTERS}0-9]++|\s+(?!\S)|\s+")
_OTHER = re.compile(r"[^\n\x20-\x7E\xA1-\xB1\xB4-\xB8\xBA\xBB\xBF-ɏ‐-…]")
MEMO_ENTRIES = 1_400_000


def words_of(text: str) -> list[str]:
    """The words of a text; joined, they are the text."""
    return (PATTERN if _OTHER.search(text) else LATIN).findall(text)


def worker_memo(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, shared by its tasks."""
    home = sys.modules.setdefault("lakeline_worker_memo", types.ModuleType("lakeline_worker_memo"))
    return home.__dict__.setdefault(name, {})


class Coder:
    """Whole texts as lists of words, with what each word's ids look like in ``views``.

    ``encode`` gives the ids of each of a list of words, and a view turns the ids of one word into
    text or bytes; that of a whole text is that of its words one after the other. The special token's
    string is one word. The memo of a ``name`` outlives the task. It starts again beyond ``entries`` words, counted in each view.
    """

    def __init__(self, name: str | None, special: str, special_id: int,
                 encode: Callable[[list[str]], list[list[int]]], *views: Callable[[list[int]], str | bytes],
                 entries: int = MEMO_ENTRIES):
        self.known = [worker_memo(f"{name} {number}") if name else {} for number in range(len(views))]
        self.special, self.special_id, self.encode, self.views = special, special_id, encode, views
        self.entries = entries

    def words(self, texts: list[str]) -> list[list[str]]:
        """The words of each text, all of them known to every view."""
        cut = [self._cut(text) for text in texts]
        first = self.known[0]
        fresh = {word for words in cut for word in words if word not in first}
        if (len(first) + len(fresh)) * len(self.known) > self.entries:
            for known in self.known:
                known.clear()
            fresh = {word for words in cut for word in words}
        if fresh:
            names = list(fresh - {self.special})
            ids = self.encode(names)
            if self.special in fresh:
                names, ids = names + [self.special], [*ids, [self.special_id]]
            for known, view in zip(self.known, self.views):
                known.update(zip(names, map(view, ids)))
        return cut

    def _cut(self, text: str) -> list[str]:
        if self.special not in text:
            return words_of(text)
        head, *parts = text.split(self.special)
        found = words_of(head)
        for part in parts:
            found.append(self.special)
            found.extend(words_of(part))
        return found
