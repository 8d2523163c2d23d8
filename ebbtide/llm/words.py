"""Words as 64-bit hashes: straight from the bytes of many texts, or by normal form with a cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import xxhash

CACHE_ENTRIES = 200_000


class WordHashes(dict):
    """Maps words to hashes of their normal form; words without one are dropped.

    ``normal`` gets a word (text or bytes) and returns the bytes of its normal form (b"" drops it).
    """

    def __init__(self, normal: Callable[[str | bytes], bytes], entries: int = CACHE_ENTRIES):
        super().__init__()
        self._normal, self._entries = normal, entries

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self._entries:
            self.clear()
        form = self._normal(word)
        # 0 marks a dropped word; a hash is never 0.
        value = (xxhash.xxh3_64_intdigest(form) or 1) if form else 0
        if len(word) <= 64:
            self[word] = value
        return value

    def hashes(self, words: list) -> np.ndarray:
        """One uint64 a word, 0 for dropped words."""
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_NOT_WORD = re.compile(r"[\W_]+")


def letters_and_digits(word: str) -> bytes:
    """Lower case, without punctuation."""
    return _NOT_WORD.sub("", word).lower().encode("utf-8", "surrogatepass")


def mixed(keys: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit keys (fixed multipliers of splitmix64)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
GROUP_BYTES = 120_000
LONG_WORD = 1024
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
#: What is left of eight little-endian bytes when only the first 0 to 8 belong to a word.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hashes_at(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings at ``starts``; ``data`` goes on for eight bytes after the last.

    Length and bytes are mixed, eight at a time, each step one to one.
    """
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # eight bytes from each byte on
    found = mixed(sizes.astype(np.uint64))
    rows, at, left, state = None, starts, sizes, found
    while len(at):
        state = mixed(state ^ (eights[at] & _FIRST_BYTES[np.minimum(left, 8)]))
        if rows is None:
            found = state
        else:
            found[rows] = state
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left, state = at[more] + 8, left[more] - 8, state[more]
    return found


def _hashes_of(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``text``."""
    if lower:
        text = text.translate(_LOWER)
    data = np.frombuffer(text + bytes(8), np.uint8)
    blank = np.concatenate([[True], BLANKS[data[:-8]], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    long = np.flatnonzero(sizes > LONG_WORD)
    if not len(long):
        return starts, hashes_at(data, starts, sizes)
    short = np.flatnonzero(sizes <= LONG_WORD)
    found = np.empty(len(starts), np.uint64)
    found[short] = hashes_at(data, starts[short], sizes[short])
    for k in long:
        found[k] = xxhash.xxh3_64_intdigest(text[starts[k] : starts[k] + sizes[k]])
    return starts, found


def _stretches(text: bytes) -> Iterator[bytes]:
    """``text`` in stretches of some hundred kilobytes, cut at blanks."""
    at = 0
    while len(text) - at > 2 * GROUP_BYTES:
        end = _AFTER_BLANK(text, at + GROUP_BYTES)
        if not end:
            break
        yield text[at : end.end()]
        at = end.end()
    yield text[at:] if at else text


_AFTER_BLANK = re.compile(rb"[\x20\x09-\x0D]").search


def joined_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, which end at blanks, and where each text's end; ``lower`` takes A-Z as a-z.

    A word's hash mixes its length and its bytes, eight at a time, each step one to one; no family of
    words is known to collide. Words of more than ``LONG_WORD`` bytes are hashed whole. A long text is
    worked through in stretches, so beyond the text itself memory follows ``GROUP_BYTES`` or its
    longest word.
    """
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(texts) == 1:
        found = np.concatenate([_hashes_of(part, lower)[1] for part in _stretches(texts[0])])
        return found, np.array([len(found)])
    starts, found = _hashes_of(b" ".join(texts), lower)
    return found, np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]))


def split_hashes(texts: list[bytes], lower: bool = False) -> list[np.ndarray]:
    """For each text the hashes of its words, as ``joined_hashes`` gives them."""
    found, ends = joined_hashes(texts, lower)
    return np.split(found, ends[:-1]) if texts else []


def grouped(column) -> Iterator[list[bytes]]:
    """The texts of an Arrow column as bytes, some hundred kilobytes at a time."""
    group, size = [], 0
    for value in column.cast("binary"):
        text = value.as_py()
        if len(text) > GROUP_BYTES and group:  # a long text goes alone
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
        if size > GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group
