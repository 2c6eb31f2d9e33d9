"""Byte-level BPE ids of whole texts through caches of pre-tokens and words.

Byte-level BPE never merges across pre-tokens, and a blank between two words
always opens the next pre-token. So a text's ids are the ids of its words, each
with the blank before it, wherever no longer run of white space crosses such a
cut. Both caches are bounded: a full cache is emptied. The pattern is that of the public
byte-level vocabularies, in which runs of letters, of numbers and of other marks stand
apart.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Hashable

import regex
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space that crosses a cut at a blank.
_CROSSING = re.compile(r"\s (?:\s|\Z)")


#: Marks that the pattern keeps apart from letters before them.
_MARKS = frozenset(".,;:!?")


def worker_local(key: Hashable, make: Callable[[], object]) -> object:
    """``make()``, kept for later tasks of this Python worker. Only the last key's is kept."""
    kept = sys.modules.setdefault("_clickloom_worker", types.ModuleType("_clickloom_worker"))
    if getattr(kept, "key", None) != key:
        kept.value = make()
        kept.key = key
    return kept.value


def release_worker() -> None:
    """Free what ``worker_local`` keeps, before a task that needs the memory."""
    sys.modules.pop("_clickloom_worker", None)


class _Cache(dict):
    def __init__(self, make: Callable[[str], bytes], entries: int, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest = make, entries, longest

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


class CachedIds:
    """Ids of a text as little-endian unsigned 32-bit integers, by any encoder of pre-tokens."""

    def __init__(self, encode: Callable[[str], list[int]], pattern: str, entries: int = 560_000):
        split = regex.compile(pattern).findall

        def pack(pretoken: str) -> bytes:
            return b"".join([i.to_bytes(4, "little") for i in encode(pretoken)])

        pre = _Cache(pack, entries // 4).__getitem__

        def word(word: str) -> bytes:
            # letters, and letters with one mark behind them, need no search
            if word.isalpha():
                return pack(" " + word)
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self._word(word[:-1]) + pre(word[-1])
            return self._whole(" " + word)

        self._whole = lambda text: b"".join(map(pre, split(text)))
        self._word = _Cache(word, entries).__getitem__

    def __call__(self, text: str) -> bytes:
        if _CROSSING.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return self._whole(first) + b"".join(map(self._word, rest))
