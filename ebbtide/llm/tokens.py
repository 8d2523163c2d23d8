"""Exact token ids of a byte-level BPE with a cache of units.

Byte-level BPE cuts a text into pieces before it merges, and some cuts can be told from two
neighbouring bytes alone: before white space that follows a visible character, between a letter and
a full stop or comma, and after a line break between a visible character and a letter. Between
two such cuts lies a unit, mostly a word with the blank before it. Units repeat, so their ids are
kept, and only new units go to the tokenizers library: many in one text, kept apart by a byte that no merge of
the vocabulary contains. Everything else is array work over a megabyte of texts at a time: cuts,
hashes of the units, a look-up in sorted hashes, and one gather of all ids.

What the two bytes do not settle is not cut, so such units are longer and still right. Units that
are long, hold the separating byte, start with an apostrophe or end in white space that goes on are
encoded alone; a text with the string of an added token goes to the library whole. The
ids are those of ``encode(text, add_special_tokens=False)`` of the tokenizer as its file has it: the
string of an added token, such as ``<|endoftext|>``, gets that token's id.

Memory. The cache has two generations of at most ``entries`` units (about 35 bytes each); a full one becomes
the old one, so frequent units survive. A text is worked through in stretches of about ``GROUP_BYTES``.
Units are told apart by 64-bit hashes that are one to one for units of equal length up to eight bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from ebbtide.llm.words import hashes_at

CACHE_ENTRIES = 1_000_000  # of one generation
GROUP_BYTES = 1_000_000
LONG_UNIT = 96
UNITS_A_TEXT = 2_000
TEXTS_A_CALL = 16

_BYTES = np.arange(256)
#: Visible ASCII; ASCII letters; full stop and comma; ASCII white space.
_VISIBLE = (_BYTES > 0x20) & (_BYTES < 0x7F)
_LETTER = np.isin(_BYTES, np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_MARK = np.isin(_BYTES, [0x2C, 0x2E])
_SPACE = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
_FOLLOWS = (_BYTES >= 0x80) & (_BYTES < 0xC0)
#: First bytes of characters of two and three bytes none of which is white space.
_TWO = (_BYTES >= 0xC3) & (_BYTES < 0xE0)
_THREE = (_BYTES >= 0xE4) & (_BYTES < 0xF0)


def _visible_before(data: np.ndarray) -> np.ndarray:
    """For each place whether the character that ends there is certainly not white space."""
    out = _VISIBLE[data]
    follows = np.flatnonzero(_FOLLOWS[data])
    if len(follows):
        two, three = np.maximum(follows - 1, 0), np.maximum(follows - 2, 0)
        out[follows] = _TWO[data[two]] | (_FOLLOWS[data[two]] & _THREE[data[three]])
    return out


def _cuts(data: np.ndarray, visible: np.ndarray) -> np.ndarray:
    """For each place but the first whether a piece certainly starts there."""
    letter, mark, space, line = _LETTER[data], _MARK[data], _SPACE[data], data == 0x0A
    cut = visible[:-1] & space[1:]
    cut |= letter[:-1] & mark[1:]
    cut |= mark[:-1] & letter[1:]
    cut[1:] |= visible[:-2] & line[1:-1] & letter[2:]
    return cut


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


class _Table:
    """Ids by hash, in sorted hashes and one array of ids."""

    def __init__(self):
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.starts, self.counts, self.flat = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """New keys, sorted, with their ids one after another."""
        at = np.searchsorted(self.keys, keys)
        self.slots = np.insert(self.slots, at, len(self.starts) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.flat = np.concatenate([self.flat, ids])


class UnitCachedEncoder:
    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = [token.content.encode() for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile(b"|".join(map(re.escape, added))).search if added else lambda text: None
        self._young, self._old, self._entries = _Table(), _Table(), entries
        self._apart = next((b for b in (0, 1, 2, 3) if self._alone(b)), None)

    def _alone(self, byte: int) -> bool:
        """Whether the byte is a token of its own beside any other."""
        one = self._tokenizer.encode(chr(byte), add_special_tokens=False)
        if len(one.ids) != 1:
            return False
        return sum(one.tokens[0] in token for token in self._tokenizer.get_vocab()) == 1

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for k in range(0, len(texts), TEXTS_A_CALL):
            found = self._tokenizer.encode_batch_fast(texts[k : k + TEXTS_A_CALL], add_special_tokens=False)
            out += [np.array(one.ids, np.uint32) for one in found]
        return out

    def _encoded_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and ids of units, many of them in one text."""
        if self._apart is None:
            found = self._encoded([unit.decode() for unit in units])
            return np.array([len(ids) for ids in found]), np.concatenate([np.empty(0, np.uint32), *found])
        mark = bytes([self._apart])
        (mark_id,) = self._tokenizer.encode(mark.decode(), add_special_tokens=False).ids
        texts = [mark.join([*units[k : k + UNITS_A_TEXT], b""]).decode() for k in range(0, len(units), UNITS_A_TEXT)]
        ids = np.concatenate([np.empty(0, np.uint32), *self._encoded(texts)])
        ends = np.flatnonzero(ids == mark_id)
        return np.diff(ends, prepend=-1) - 1, ids[ids != mark_id]

    def _slots(self, data: np.ndarray, text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The units' places in the young generation, new ones encoded."""
        if len(self._young) >= self._entries:
            self._old, self._young = self._young, _Table()
        keys, first, inverse = np.unique(hashes_at(data, starts, sizes), return_index=True, return_inverse=True)
        slots = self._young.find(keys)
        new = np.flatnonzero(slots < 0)
        if len(new):
            old = self._old.find(keys[new])
            again = old >= 0
            if again.any():
                slots[new[again]] = len(self._young.starts) + np.arange(again.sum())
                counts = self._old.counts[old[again]]
                self._young.add(keys[new[again]], counts, gathered(self._old.flat, self._old.starts[old[again]], counts))
                new = new[~again]
        if len(new):
            at = first[new]
            units = [text[a:b] for a, b in zip(starts[at].tolist(), (starts[at] + sizes[at]).tolist())]
            slots[new] = len(self._young.starts) + np.arange(len(new))
            self._young.add(keys[new], *self._encoded_units(units))
        return slots[inverse]

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        text = b"".join(texts)
        ends = np.cumsum([len(one) for one in texts])
        data = np.frombuffer(text + bytes(8), np.uint8)
        body = data[:-8]
        if not len(body):
            return [np.empty(0, np.uint32) for _ in texts]
        visible = _visible_before(body)
        cut = np.concatenate([[True], _cuts(body, visible), [True]])
        cut[ends] = True
        edges = np.flatnonzero(cut)
        starts, sizes = edges[:-1], np.diff(edges)
        last = np.isin(edges[1:], ends)  # nothing is known of what follows: white space there may go on
        alone = (sizes > LONG_UNIT) | (body[starts] == 0x27) | (last & ~visible[edges[1:] - 1])
        if self._apart is not None and (holds := np.flatnonzero(body == self._apart)).size:
            alone[np.searchsorted(edges, holds, "right") - 1] = True
        cached = np.flatnonzero(~alone)
        slots = self._slots(data, text, starts[cached], sizes[cached])
        counts, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        counts[cached], at[cached] = self._young.counts[slots], self._young.starts[slots]
        flat, singles = self._young.flat, np.flatnonzero(alone)
        if len(singles):
            found = self._encoded([text[a : a + n].decode() for a, n in zip(starts[singles].tolist(), sizes[singles].tolist())])
            counts[singles] = [len(ids) for ids in found]
            at[singles] = len(flat) + np.cumsum(counts[singles]) - counts[singles]
            flat = np.concatenate([flat, *found])
        ids = gathered(flat, at, counts)
        before = np.concatenate([[0], np.cumsum(counts)])
        return np.split(ids, before[np.searchsorted(edges, ends[:-1])])

    def encode(self, texts: Iterable[str | bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for text in texts:
            text = text.encode() if isinstance(text, str) else text
            whole = self._added(text)
            if group and (whole or size + len(text) > GROUP_BYTES):
                yield from (ids.astype("<u4").tobytes() for ids in self._group(group))
                group, size = [], 0
            if whole:
                yield self._encoded([text.decode()])[0].astype("<u4").tobytes()
            elif len(text) > GROUP_BYTES:
                yield b"".join(self._group([part])[0].astype("<u4").tobytes() for part in _stretches(text))
            else:
                group.append(text)
                size += len(text)
        if group:
            yield from (ids.astype("<u4").tobytes() for ids in self._group(group))


#: A blank between visible characters, before a letter: a piece starts there.
_CUT = re.compile(rb"(?<=[!-~])(?= [A-Za-z])").search


def _stretches(text: bytes) -> Iterator[bytes]:
    """``text`` in stretches that start where a piece does."""
    at = 0
    while len(text) - at > GROUP_BYTES:
        found = _CUT(text, at + GROUP_BYTES // 2)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


@lru_cache(maxsize=1)
def encoder(path: str, entries: int = CACHE_ENTRIES) -> UnitCachedEncoder:
    """One encoder per worker process and tokenizer file."""
    return UnitCachedEncoder(path, entries)


def default_tokenizer() -> str:
    """The public byte-level BPE file; every machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
