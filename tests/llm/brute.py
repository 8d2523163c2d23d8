"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from itertools import combinations


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def exact(rows):
    """(doc_id, keep_id, group_size, sha256) sorted; which of several equal rows stays is open."""
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows, percent=80):
    """n_shingles and component_id per row position."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
            parent[find(b)] = find(a)
    members = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            members.setdefault(find(k), []).append(i)
    return [(i, len(sets[k]), min(members[find(k)], default=None) if find(k) in members else None) for k, (i, _) in enumerate(rows)]


def byte_repeats(rows, length=50):
    last = 1 << 63
    first = {}
    data = [(i, (text or "").encode()) for i, text in rows]
    for i, text in data:
        for k in range(len(text) - length + 1):
            key = text[k : k + length]
            first[key] = min(first.get(key, last), last - 1 if i is None else i)
    out = []
    for i, text in data:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if first[text[k : k + length]] < (last - 1 if i is None else i):
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((i, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def word_repeats(rows, window=35):
    data = [(i, (text or "").encode().split()) for i, text in rows]
    counts = Counter(tuple(words[k : k + window]) for _, words in data for k in range(len(words) - window + 1))
    out = []
    for i, words in data:
        gone = bytearray(len(words))
        for k in range(len(words) - window + 1):
            if counts[tuple(words[k : k + window])] > 1:
                gone[k : k + window] = b"\1" * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x if x is not None else 0) if not isinstance(x, str) else (False, x) for x in row)
