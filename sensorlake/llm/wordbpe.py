"""Token ids of many texts at once, by a tokeniser file of byte-pair merges with word ends.

The tokeniser's pre-tokens don't depend on their neighbours, so each distinct one is merged
once. Those of Latin-1 letters, digits and signs are merged together as rows of a numpy
matrix, with the file's own table; all other words go through the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

ID = np.dtype("<u4")
# Latin-1 letters, numbers and white space, as the file's pattern groups them.
LETTERS, NUMBERS, SPACES = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
# Letters first, as the commonest; no letter begins another kind.
LATIN = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
# What a file must say for the matrix to apply.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LONGEST = 32
# A word's rows fit in these bits.
ROW_BITS = 6
# Merges are found by a hash of their pair.
SLOT_BITS = 18
# Distinct pre-tokens kept in each of two generations.
MOST_KEPT = 100_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else one above 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [rest.get(b, chr(b)) for b in range(256)]


def _slots(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def _by_size(words: list[str], size: Callable[[str], int]) -> Iterator[list[str]]:
    words.sort(key=size)
    for at in range(0, len(words), 8192):
        yield words[at:at + 8192]


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBpe:
    """The tokeniser of a file, kept for the next tasks of a Python worker."""
    return WordBpe(path)


class WordBpe:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        spec = json.loads(self.library.to_str())
        parts = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        model = spec["model"]
        self.matrix = (parts[:1] == [PATTERN] and kinds == ["NFC", "Replace", "Lowercase"]
                       and model["end_of_word_suffix"] == "</w>" and not model["dropout"])
        if self.matrix:
            self._read(model)

    def _read(self, model: dict) -> None:
        vocab, letters = model["vocab"], byte_letters()
        self.first = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + "</w>"] for x in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # The last entry stands for pairs without a merge; it equals no pair.
        self.pairs = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs] + [-2], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        self.table = np.full(1 << SLOT_BITS, self.none, np.int32)
        left = np.arange(self.none)
        at = _slots(self.pairs[:-1])
        while len(left):
            free = self.table[at] == self.none
            self.table[at[free]] = left[free]
            off = self.table[at] != left
            left, at = left[off], (at[off] + 1) & (len(self.table) - 1)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self._pre_tokens(t or "") for t in texts]
        if len(self.new) > MOST_KEPT:
            self.old, self.new = self.new, {}
        fresh = []
        for word in set().union(*split).difference(self.new):
            known = self.old.get(word)
            if known is None:
                fresh.append(word)
            else:
                self.new[word] = known
        self._learn(fresh)
        return [b"".join(map(self.new.__getitem__, words)) for words in split]

    def _pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of Latin-1 words, and other words whole."""
        if self.matrix and _latin(text):
            return LATIN.findall(text.lower())
        out: list[str] = []
        for word in re.split("[ \t\n\r\x0b\x0c]+", text):
            if word:
                out += LATIN.findall(word.lower()) if self.matrix and _latin(word) else [word]
        return out

    def _learn(self, words: list[str]) -> None:
        # Words of ASCII become rows at once; a zero byte would look like a row's end.
        plain: list[str] = []
        other: dict[str, bytes] = {}
        for word in words:
            if self.matrix and word.isascii() and len(word) <= LONGEST and "\0" not in word:
                plain.append(word)
            elif self.matrix and _latin(word) and len(raw := word.encode()) <= LONGEST:
                other[word] = raw
            else:
                ids = self.library.encode(word, add_special_tokens=False).ids
                self.new[word] = np.array(ids, ID).tobytes()
        for part in _by_size(plain, len):
            data = np.array(part, "S").view(np.uint8).reshape(len(part), -1)
            self._keep(part, data, np.array(list(map(len, part))))
        for part in _by_size(list(other), lambda w: len(other[w])):
            raws = [other[w] for w in part]
            width = len(raws[-1])
            data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raws), np.uint8).reshape(-1, width)
            self._keep(part, data, np.array(list(map(len, raws))))

    def _keep(self, words: list[str], data: np.ndarray, sizes: np.ndarray) -> None:
        self.new.update(zip(words, self._merge(data, sizes)))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge; the number of merges for pairs that have none (such as with -1)."""
        pair = a << 20 | b
        at = _slots(pair)
        rank = self.table[at]
        off = np.flatnonzero((self.pairs[rank] != pair) & (rank < self.none))
        while len(off):
            at[off] = (at[off] + 1) & (len(self.table) - 1)
            found = self.table[at[off]]
            rank[off] = found
            off = off[(self.pairs[found] != pair[off]) & (found < self.none)]
        return rank

    def _merge(self, data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Merge the lowest-ranked pair of every word, the leftmost of equals, until none is left.

        Words are columns. Their ids stay in place as a chain: ``ahead`` and ``before`` lead past ids
        that were merged into others. The first and last row stand before and behind every word.
        """
        n, width = data.shape
        every = np.arange(n)
        ids = np.full((width + 2, n), -1, np.int64)
        ids[1:-1] = np.where(np.arange(width)[:, None] < sizes, self.first[data.T], -1)
        ids[sizes, every] = self.last[data[every, sizes - 1]]
        places = np.arange(ids.size).reshape(ids.shape)
        ahead, before = places + n, places - n
        ahead[sizes, every] = places[-1]
        # A pair's rank above its row: the least is the first to merge.
        keys = np.full((width + 1, n), self.none << ROW_BITS, np.int32)
        keys[1:] = self._ranks(ids[1:-1].ravel(), ids[2:].ravel()).reshape(width, n) << ROW_BITS
        keys |= np.arange(width + 1, dtype=np.int32)[:, None]
        ids_at, ahead_at, before_at, keys_at = (x.reshape(-1) for x in (ids, ahead, before, keys))
        while True:
            lowest = keys.min(axis=0)
            live = np.flatnonzero(lowest < self.none << ROW_BITS)
            if not len(live):
                break
            lowest = lowest[live]
            at = (lowest & (1 << ROW_BITS) - 1).astype(np.int64) * n + live
            gone = ahead_at[at]
            then, back = ahead_at[gone], before_at[at]
            ids_at[at] = own = self.merged[lowest >> ROW_BITS]
            ids_at[gone] = -1
            keys_at[gone] = self.none << ROW_BITS
            ahead_at[at], before_at[then] = then, at
            keys_at[at] = self._ranks(own, ids_at[then]) << ROW_BITS | at // n
            keys_at[back] = self._ranks(ids_at[back], own) << ROW_BITS | back // n
        rows = ids.T
        there = rows >= 0
        packed = rows[there].astype(ID).tobytes()
        ends = (np.cumsum(there.sum(axis=1)) * ID.itemsize).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]
