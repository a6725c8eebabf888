"""Byte-pair encoding of whole texts through caches of words, and the heap-and-linked-list count of a word's tokens.

The pre-tokeniser never joins a character that isn't white space with white space right of it, so a text can be cut before
every such white space and the parts encoded by themselves. Parts repeat, so each is split into pre-tokens and encoded once a
worker as long as the cache holds it.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable

import numpy as np
import regex

#: Fixed value: the pre-tokeniser of byte-level BPE files that say "use_regex", with white space as Unicode has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Parts that a worker's cache holds of each generation; the older of two is dropped, so memory is bounded.
HELD = 150_000


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where it prints, else as one of the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ranks and ids of a byte-level BPE file in the tokenizers library's JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw = byte_letters()
        as_bytes = lambda s: bytes(raw[c] for c in s)
        self.ids = {as_bytes(k): v for k, v in spec["model"]["vocab"].items() if all(c in raw for c in k)}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merges = {(self.ids[a], self.ids[b]): (r, self.ids[a + b]) for r, (a, b) in enumerate((as_bytes(x), as_bytes(y)) for x, y in pairs)}
        self.first = [self.ids[bytes([i])] for i in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token: its bytes, less one for each merge. Pops the lowest-ranked adjacent pair, leftmost first.

        The symbols form a linked list (after, before); an entry of the heap is stale if either symbol has changed since.
        """
        n = len(word)
        if n < 2:
            return n
        merges, sym = self.merges, [self.first[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = merges.get((sym[i], sym[i + 1]))
            if m is not None:
                heap.append((m[0], i, sym[i], sym[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= len(sym) or sym[j] != right:
                continue
            sym[i], sym[j] = new, -1
            after[i] = k = after[j]
            n -= 1
            if k < len(sym):
                before[k] = i
                m = merges.get((new, sym[k]))
                if m is not None:
                    heapq.heappush(heap, (m[0], i, new, sym[k], m[1]))
            h = before[i]
            if h >= 0:
                m = merges.get((sym[h], new))
                if m is not None:
                    heapq.heappush(heap, (m[0], h, sym[h], new, m[1]))
        return n


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


class Parts:
    """encode(pre-token) for each part of a text, kept in two generations of a bounded cache; add joins those of a part."""

    def __init__(self, vocab: Vocabulary, encode: Callable[[bytes], object], add: Callable[[list], object]):
        self.vocab, self.encode, self.add = vocab, encode, add
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def get(self, part: str):
        v = self.new.get(part)
        if v is None:
            v = self.old.get(part)
            if v is None:
                pieces = plain(part) if part.isascii() else None
                if pieces is None:
                    pieces = self.vocab.pattern.findall(part)
                v = self.add([self.get(p) for p in pieces]) if len(pieces) != 1 else self.encode(part.encode("utf-8", "surrogatepass"))
            if len(part) < 64:
                self.new[part] = v
        return v

    def values(self, text: str) -> list:
        """Of the parts, in order; special tokens of the vocabulary are parts by themselves."""
        if len(self.new) > HELD:
            self.old, self.new = self.new, {}
        if self.vocab.split is not None and any(s in text for s in self.vocab.special):
            out = []
            for i, x in enumerate(self.vocab.split.split(text)):
                out += [self.special(x)] if i % 2 else self._plain(x)
            return out
        return self._plain(text)

    def special(self, name: str):
        return 1

    def _plain(self, text: str) -> list:
        if odd(text) or "\0" in text:
            return [self.get(p) for p in self.vocab.pattern.findall(text)]
        # words keep the space before them, line feeds are by themselves
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        found = list(map(self.new.get, parts))
        if None in found:
            found = [self.get(w) if v is None else v for w, v in zip(parts, found, strict=True)]
        return found


def plain(part: str) -> tuple[str, ...] | None:
    """Pre-tokens of a space and ASCII letters (one), with a point or comma after them (two); None: ask the pattern."""
    word = part.removeprefix(" ")
    if word.isalpha():
        return (part,)
    return (part[:-1], word[-1]) if word[-1:] in (",", ".") and word[:-1].isalpha() else None


#: Two white spaces in a row, or any but a space or a line feed: such texts go through the pattern as a whole.
ODD = re.compile(r"\s\s|[^\S \n]")
#: The same in ASCII texts, where plain searches are faster.
ODD_ASCII = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f")


def odd(text: str) -> bool:
    return any(x in text for x in ODD_ASCII) if text.isascii() else ODD.search(text) is not None
