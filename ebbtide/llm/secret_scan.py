"""Secrets in texts: fixed patterns, and values of credential contexts that are costly to guess.

Patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost and without overlap over whole
texts; a match that fails its length test is dropped and what it covered stays covered.

Guess cost. A value that stands where a credential is named (:data:`CONTEXT`) is a secret of kind
``guess`` when it takes at least ``2 ** MIN_BITS`` guesses. Its cost is the cheapest way to write it
as a row of spans, found by dynamic programming over its characters:

* a word of the lexicon: -log2 of its share of all words of the corpus, plus a bit or two for
  capitals and for digits that stand for letters;
* a date: four to eight digits, with or without separators, in a plausible order;
* a repeat: a block of up to ``BLOCK`` characters again and again: the block and the count;
* a keyboard walk: three or more neighbouring keys, a start and a turn each;
* brute force: the size of the character's own class.

The lexicon holds the words that take at most ``2 ** WORD_BITS`` guesses, that is, whose share of
all words of the corpus is ``2 ** -WORD_BITS`` or more. There are at most ``2 ** WORD_BITS`` of these, of at most
``WORD_LETTERS`` letters, so the broadcast is below 10 MB for any corpus. Words are counted over all
texts, combined before the shuffle, and only where a blank-separated token is letters, so the values
that are looked for do not teach the lexicon their own pieces.

Defined results: a null text is empty and has no spans; an empty table gives no rows; every row gets
one row, whatever its id; repeated rows are rows of their own; other columns are ignored. A very long
text costs a small multiple of its own memory; a very long value costs one pass with a window of costs, which ends
as soon as no way below the threshold is left.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import arrow_map, id_and_text, type_name, written

#: Fixed patterns of the base kinds; letters of the keywords in either case, ASCII only.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a run of 16 or more: shorter runs hold no longer one
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
KINDS = ["assign", "access", "hex", "guess"]

#: Where a credential is named; group 1 is a quoted value, group 2 one that ends at a blank or quote.
CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|bearer|auth)"""
    r"""["']?[\x20\t]*(?:[:=]|=>|:=)[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>]+))""",
    re.ASCII,
)
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth")
MIN_BITS = 33.0  # ten thousand million guesses
WORD_BITS = 16.0
WORD_LETTERS = 32
WORD_LEAST = 3
BLOCK = 16
#: Keys in rows as they lie; a key's neighbours are those beside, above and below it.
KEYBOARD = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"]
#: Digits and signs that stand for letters.
STANDS_FOR = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)?\d\d)"
    r"|(?:0?[1-9]|1[0-2])([-/._]?)(?:0?[1-9]|[12]\d|3[01])\3(?:(?:19|20)?\d\d)"
    r"|(?:19|20)\d\d)"
)
#: Bits of a date: a day of some hundred years, and of a year alone; two bits for separators and order.
DATE_BITS, YEAR_BITS = math.log2(366 * 120) + 2, math.log2(120)


def _neighbours() -> dict[str, set[str]]:
    place = {key: (row, column) for row, keys in enumerate(KEYBOARD) for column, key in enumerate(keys)}
    near = lambda a, b: abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1 and a != b
    return {key: {other for other in place if near(place[key], place[other])} for key in place}


NEIGHBOURS = _neighbours()
START_BITS, TURN_BITS = math.log2(len(NEIGHBOURS)), 2.0


def _letter_bits(letter: str) -> float:
    if letter.isascii():
        if letter.isdigit():
            return math.log2(10)
        return math.log2(26) if letter.isalpha() else math.log2(33)
    return math.log2(256)


class GuessCost:
    """Bits of the guesses that a value takes. ``lexicon`` maps lower-case words to their bits."""

    def __init__(self, lexicon: dict[str, float], block: int = BLOCK):
        self._lexicon, self._block = lexicon, block
        self._lengths = sorted({len(word) for word in lexicon})

    def bits(self, value: str, enough: float = math.inf) -> float:
        """The least cost of ``value``; any number of at least ``enough`` if it is no less than that."""
        n, reach = len(value), max([self._block, 10, *self._lengths])
        small = value.lower()
        if len(small) != n:  # letters whose small form is longer stand for themselves
            small = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        plain = small.translate(STANDS_FOR)
        best = {0: 0.0}  # by position, only where something may still start
        far: dict[int, float] = {}  # ends of repeats beyond the window
        walk = [math.inf] * 3  # cost of a walk of one, two, three or more keys that ends here
        ends = [0] * (self._block + 1)  # where the run of each period ends, as far as known
        for i in range(n):
            here = min(best.pop(i, math.inf), far.pop(i, math.inf), walk[2])
            if enough < math.inf and min([here, *walk, *best.values(), *far.values()]) >= enough:
                return enough
            key, before = small[i], small[i - 1] if i else ""
            beside = key in NEIGHBOURS.get(before, ())
            step = lambda cost: cost + TURN_BITS if beside else math.inf
            walk = [here + START_BITS if key in NEIGHBOURS else math.inf, step(walk[0]), min(step(walk[1]), step(walk[2]))]
            if here == math.inf:
                continue
            offer = lambda end, cost: best.__setitem__(end, min(best.get(end, math.inf), here + cost))
            offer(i + 1, _letter_bits(value[i]))
            for size in self._lengths:
                if i + size > n:
                    break
                cost = self._lexicon.get(small[i : i + size], math.inf)
                if plain[i : i + size] != small[i : i + size]:
                    cost = min(cost, self._lexicon.get(plain[i : i + size], math.inf) + 1)
                if cost < math.inf:
                    offer(i + size, cost + _capital_bits(value[i : i + size]))
            if key.isdigit() and (date := DATE.match(value, i)):
                offer(date.end(), YEAR_BITS if date.end() - i <= 4 else DATE_BITS)
            for period in range(1, min(self._block, (n - i) // 2) + 1):
                if ends[period] < i + period:
                    end = i + period
                    while end < n and value[end] == value[end - period]:
                        end += 1
                    ends[period] = end
                times = (ends[period] - i) // period
                if times >= 2:
                    end = i + times * period
                    cost = here + self._block_bits(value[i : i + period]) + math.log2(times)
                    into = best if end - i <= reach else far
                    into[end] = min(into.get(end, math.inf), cost)
        return min(best.get(n, math.inf), far.get(n, math.inf), walk[2], 0.0 if not n else math.inf)

    def _block_bits(self, block: str) -> float:
        """A block of a repeat: as a word if it is one, else letter by letter."""
        word = self._lexicon.get(block.lower(), math.inf) + _capital_bits(block)
        return min(word, sum(map(_letter_bits, block)))


def _capital_bits(word: str) -> float:
    if word == word.lower():
        return 0.0
    return 1.0 if word == word.upper() or word == word.capitalize() else min(len(word), 4.0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values of credential contexts, without a closing full stop, comma or bracket."""
    if not any(map(text.lower().__contains__, HINTS)):
        return
    for match in CONTEXT.finditer(text):
        start, end = next(match.span(k) for k in (1, 2, 3) if match[k] is not None)
        while end > start and text[end - 1] in ".,;:)]}":
            end -= 1
        if end > start:
            yield start, end


def spans(text: str, cost: GuessCost, min_bits: float = MIN_BITS) -> tuple[list, list]:
    """The base spans, and these with the values added that take ``2 ** min_bits`` guesses; in order."""
    order = lambda span: (span[0], KINDS.index(span[2]), span[1])
    base = sorted(base_spans(text), key=order)
    starts, ends = [], []  # of the stretches that the base spans cover
    for start, end, _ in base:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    more = []
    for start, end in context_values(text):
        first = bisect_left(ends, start + 1)
        covered = first < len(starts) and starts[first] < end
        if not covered and cost.bits(text[start:end], min_bits) >= min_bits:
            more.append((start, end, "guess"))
    return base, sorted(base + more, key=order)


def _words(text: str, at_once: int = 1 << 20) -> Iterator[list[str]]:
    """The blank-separated tokens of ``text`` in small letters, a stretch at a time."""
    at = 0
    while len(text) - at > 2 * at_once:
        end = _BLANK.search(text, at + at_once)
        if not end:
            break
        yield text[at : end.start()].lower().split()
        at = end.end()
    yield (text[at:] if at else text).lower().split()


_BLANK = re.compile(r"\s")
MARKS = ".,;:!?()\"'"
HELD_WORDS = 200_000


def lexicon(texts: DataFrame, word_bits: float = WORD_BITS) -> dict[str, float]:
    """Words of the ``text`` column and their bits, for those of at most ``word_bits``: no more than 2 ** ``word_bits``."""
    import pyarrow as pa

    def rows(counter):
        clean = Counter()
        for token, n in counter.items():
            word = token.strip(MARKS)
            if WORD_LEAST <= len(word) <= WORD_LETTERS and word.isalpha():
                clean[word] += n
        return pa.RecordBatch.from_arrays(
            [pa.array(list(clean), pa.string()), pa.array(list(clean.values()), pa.int64())], names=["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for tokens in _words(text.as_py()):
                    counter.update(tokens)
                    if len(counter) > HELD_WORDS:
                        yield rows(counter)
                        counter.clear()
        yield rows(counter)

    counted = arrow_map(texts.select("text"), count, "word string, n long")
    counts = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= max(1, math.ceil(total * 2.0**-word_bits))).collect()
    return {r["word"]: math.log2(total / r["n"]) for r in found}


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = MIN_BITS,
    word_bits: float = WORD_BITS, words: dict[str, float] | None = None,
) -> DataFrame:
    """One row per row: id, base and found, both arrays of (kind, start, end) in code points, in order.

    ``words`` replaces the lexicon that is otherwise learned from the texts.
    """
    import pyarrow as pa

    texts = id_and_text(docs, id_col, text_col)
    if words is None:
        words = lexicon(texts, word_bits)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(shared.value)
        as_rows = lambda found: [{"kind": k, "start": a, "end": b} for a, b, k in found]
        for batch in batches:
            base, every = [], []
            for text in batch.column(1):
                one, more = spans(text.as_py(), cost, min_bits)
                base.append(as_rows(one))
                every.append(as_rows(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(span)), pa.array(every, pa.list_(span))], names=["id", "base", "found"]
            )

    kind = "array<struct<kind: string, start: long, end: long>>"
    out = arrow_map(texts, found, f"id {type_name(texts, 'id')}, base {kind}, found {kind}")
    return out.withColumnRenamed("id", id_col)


def redacted(text: str, found: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``mask``."""
    out, at = [], 0
    for start, end, _ in sorted(found):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])

