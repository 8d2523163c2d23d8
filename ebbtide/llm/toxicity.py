"""Toxicity: gradient-boosted trees over dense features, calibrated isotonically.

Lexicon. A short list of insults, and what the labelled texts mark: words and word beginnings of 4
to 7 letters whose share among toxic texts exceeds that among clean ones ``MIN_LIFT`` times and by
``MIN_SCORE`` standard errors, each distinct text counted once. Their weight is the logarithm of
that ratio; every form that passes is kept, so the sample bounds their number. Inflected words of any language are met by beginnings.

Features of a text, all computed over the whole of it (``FEATURES``): densities of insults and of
learned weights, distinct hits, hits near a second-person word and of disguised ones (swapped characters,
stretched letters, separators, spelt with blanks), rates of capitals and punctuation, length.

Model. Trees are boosted on a bounded sample of labelled rows (``MAX_ROWS``, chosen by a hash of
the id); a fifth of it is held back and turns the trees' output into a probability by isotonic
regression. Features, trees and calibration are Spark jobs; only the lexicon, the trees and the
calibration steps (all bounded) travel to the executors.

Defined results: null and empty texts have zero densities and get the score of such texts; without
labels of both kinds, of documents at hand and both for trees and for calibration, there is no model: the
score is the share of toxic labels (0 without any), or what the caller gives for that case (the pipeline
gives 0 and so rejects nothing); unlabelled rows and null labels train nothing; repeated rows count as often as they occur; extra columns are kept by ``scored``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ebbtide.llm.common import arrow_map, free_name, written

# Common insults and second-person words.
INSULTS = (
    "asshole", "bastard", "bitch", "clown", "crap", "creep", "cretin", "degenerate", "disgusting", "dumb",
    "dumbass", "filth", "fool", "freak", "garbage", "idiot", "imbecile", "jerk", "loser", "moron", "pathetic",
    "pig", "retard", "scum", "scumbag", "shit", "slut", "stupid", "trash", "vermin", "whore", "worthless",
)
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "youre", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros",
)
DISGUISES = {"0": "o", "1": "i", "!": "i", "|": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "+": "t"}

FEATURES = (
    "hits", "hits_per_100", "distinct", "weight_per_100", "weighted", "weighted_distinct", "disguised_per_100", "addressed_per_100", "second_person_per_100",
    "capitals", "shouted_words", "marks", "exclamations", "log_words",
)
NEAR = 3  # words between an insult and a second-person word
STEMS = (4, 5, 6, 7)  # letters of a word beginning
MAX_ROWS = 20_000
MIN_LIFT, MIN_SCORE, MIN_TEXTS = 4, 5, 5
TOP_WEIGHT = 6.0
THRESHOLD = 0.7
CACHE_ENTRIES = 500_000

_INSIDE = re.compile(r"[\W_]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_SWAPS = str.maketrans(DISGUISES)
_SWAPPED = frozenset(DISGUISES)


class Reader:
    """Turns texts into features, with a bounded cache of what words are."""

    PLAIN, TOXIC, DISGUISED, ADDRESS, WEIGHTED = 1, 2, 3, 4, 5
    NOTHING = (PLAIN, "", 0.0)

    def __init__(self, forms: tuple[tuple[str, float], ...]):
        self._lexicon, self._address = frozenset(INSULTS), frozenset(SECOND_PERSON)
        self._weights = dict(forms)
        # What every learned word beginning starts with.
        self._heads = frozenset(form[: STEMS[0]] for form, _ in forms if form.endswith("*"))
        self._known: dict[str, tuple[int, str, float]] = {}
        self._letters: dict[str, str] = {}

    def forget(self) -> None:
        """Empties the caches, which only spare work."""
        self._known.clear()
        self._letters.clear()

    def _weight(self, word: str) -> float:
        get = self._weights.get
        if word[: STEMS[0]] not in self._heads:
            return get(word, 0.0)
        return max([get(word, 0.0), *[get(word[:n] + "*", 0.0) for n in STEMS if len(word) >= n]])

    def _new(self, word: str) -> tuple[int, str, float]:
        lower = word.lower()
        plain = lower if lower.isalnum() else _trimmed(lower)
        weight = self._weight(plain)
        if plain in self._lexicon:
            found = (self.TOXIC, plain, max(weight, TOP_WEIGHT / 2))
        elif weight:
            found = (self.WEIGHTED, plain, weight)
        elif plain in self._address or not plain.isalnum() and _INSIDE.sub("", plain) in self._address:
            found = (self.ADDRESS, plain, 0.0)
        elif hidden := self._hidden(lower, plain):
            found = (self.DISGUISED, hidden, TOP_WEIGHT / 2)
        else:
            found = self.NOTHING
        if len(word) <= 64:
            if len(self._known) >= CACHE_ENTRIES:
                self._known.clear()
            self._known[word] = found
        return found

    def _hidden(self, word: str, plain: str) -> str:
        """The insult that ``word`` (in lower case; ``plain`` without its edges) is a disguise of."""
        texts = [plain]
        if not _SWAPPED.isdisjoint(word):
            texts += [plain.translate(_SWAPS), word.translate(_SWAPS)]
        for text in texts:
            bare = text if text.isalnum() else _INSIDE.sub("", text)
            if bare in self._lexicon:
                return bare
            if _STRETCHED.search(bare):
                for form in (_STRETCHED.sub(r"\1", bare), _STRETCHED.sub(r"\1\1", bare)):
                    if form in self._lexicon:
                        return form
        return ""

    def _letter(self, word: str) -> str:
        """``word`` in lower case without its edges."""
        if len(self._letters) >= CACHE_ENTRIES:
            self._letters.clear()
        found = self._letters[word] = _trimmed(word.lower())
        return found

    def _spelt(self, words: list[str]) -> list[str]:
        """Insults written letter by letter."""
        out, run, get = [], [], self._letters.get
        for word in [*words, ""]:
            if len(word) > 3:
                if not run:
                    continue
                letter = ""
            elif (letter := get(word)) is None:
                letter = self._letter(word)
            if len(letter) == 1:
                run.append(letter)
                continue
            if len(run) >= 3:
                text = "".join(run)
                out += [insult for insult in self._lexicon if len(insult) >= 3 and insult in text]
            run = []
        return out

    def features(self, text: str | None) -> list[float]:
        words = (text or "").split()
        n = len(words)
        if not n:
            return [0.0] * len(FEATURES)
        get, new = self._known.get, self._new
        kinds = [get(word) or new(word) for word in words]
        marked = [(k, *kind) for k, kind in enumerate(kinds) if kind[0] != self.PLAIN]
        bad = [(k, form) for k, kind, form, _ in marked if kind in (self.TOXIC, self.DISGUISED)]
        weighted = [form for _, _, form, weight in marked if weight]
        disguised = sum(kind == self.DISGUISED for _, kind, _, _ in marked)
        address = [k for k, kind, _, _ in marked if kind == self.ADDRESS]
        spelt = self._spelt(words) if list(map(len, words)).count(1) >= 3 else []
        near, at = 0, 0
        for k, _ in bad:
            while at < len(address) and address[at] < k - NEAR:
                at += 1
            near += at < len(address) and address[at] <= k + NEAR
        hits = len(bad) + len(spelt)
        letters = sum(map(str.isalpha, text)) if not text.isascii() else len(text) - len(text.translate(_NO_LETTERS))
        capitals = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(_NO_CAPITALS))
        marks = sum(map(text.count, "!?*#@$%&"))
        shouted = sum(map(str.isupper, words))
        return [
            float(min(hits, 20)), 100.0 * hits / n, float(len({form for _, form in bad} | set(spelt))),
            100.0 * sum(weight for *_, weight in marked) / n, float(min(len(weighted), 50)), float(len(set(weighted))),
            100.0 * (disguised + len(spelt)) / n, 100.0 * near / n, 100.0 * len(address) / n,
            capitals / letters if letters else 0.0, shouted / n, marks / len(text), text.count("!") / n,
            float(n).__pow__(0.25),
        ]


def _trimmed(word: str) -> str:
    """``word`` without what stands at its edges and is no letter or digit."""
    first, last = 0, len(word)
    while last and not word[last - 1].isalnum():
        last -= 1
    while first < last and not word[first].isalnum():
        first += 1
    return word[first:last]


_NO_LETTERS = {c: None for c in (*range(65, 91), *range(97, 123))}
_NO_CAPITALS = {c: None for c in range(65, 91)}


@lru_cache(maxsize=1)
def _reader(forms: tuple[tuple[str, float], ...]) -> Reader:
    return Reader(forms)


def sample(labels: DataFrame, id_col: str, label_col: str, training: Column, max_rows: int) -> DataFrame:
    """id, label of at most ``max_rows`` labelled rows for training, by a hash of the id."""
    usable = labels.where(training & labels[label_col].isin(0, 1)).select(
        labels[id_col].alias("sample_id"), labels[label_col].cast("double").alias("label")
    )
    return written(usable.orderBy(F.xxhash64("sample_id"), "sample_id", "label").limit(max_rows), "sample")


def learn_forms(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> tuple[tuple[str, float], ...]:
    """Words, and word beginnings with a ``*``, that the sampled texts mark as toxic, with weights."""
    texts = docs.select(docs[id_col].alias("sample_id"), docs[text_col].alias("text")).join(
        F.broadcast(chosen), "sample_id"
    )
    texts = written(texts.select(F.coalesce("text", F.lit("")).alias("text"), "label").distinct(), "labelled-texts")
    totals = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1.0, 0), totals.get(0.0, 0)
    if not toxic or not clean:
        return ()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]{3,30})"), F.lit(1)))
    stems = [
        F.transform(F.filter("words", lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
        for n in STEMS
    ]
    forms = texts.select("label", words.alias("words")).select(
        "label", F.explode(F.array_distinct(F.concat("words", *stems))).alias("form")
    )
    counts = forms.groupBy("form").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    share, other = F.col("bad") / toxic, F.col("good") / clean
    pooled = (F.col("bad") + F.col("good")) / (toxic + clean)
    score = (share - other) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / clean))
    lift = share / ((F.col("good") + 0.5) / clean)
    best = (
        counts.where((F.col("bad") >= MIN_TEXTS) & (lift >= MIN_LIFT) & (pooled < 1) & (score >= MIN_SCORE))
        .select("form", F.least(F.log(lift), F.lit(TOP_WEIGHT)).alias("weight"))
    )
    return tuple(sorted((r["form"], r["weight"]) for r in best.collect()))


def with_features(docs: DataFrame, forms: tuple[tuple[str, float], ...], text_col: str, name: str) -> DataFrame:
    """``docs`` with one more column, the array of :data:`FEATURES`."""
    import pyarrow as pa

    place = docs.columns.index(text_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(forms)
        try:
            for batch in batches:
                found = pa.array([reader.features(text.as_py()) for text in batch.column(place)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])
        finally:  # the worker goes on to other stages, which need its memory
            reader.forget()

    schema = StructType([*docs.schema.fields, StructField(name, ArrayType(DoubleType()))])
    return arrow_map(docs, read, schema)


def scored(
    docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", score_col: str = "score", max_rows: int = MAX_ROWS, columns: list[str] | None = None,
    without_model: float | None = None,
) -> DataFrame:
    """``docs`` (or only ``columns`` of it) with ``score``, the calibrated probability of being toxic.

    ``training``: a condition on ``labels`` that says which rows may be learned from. ``max_rows``
    bounds the sample that trees and calibration are fitted on. ``without_model``: the score of all
    rows where labels of both kinds are not there to learn from; the share of toxic labels by default.
    """
    chosen = sample(labels, id_col, label_col, training, max_rows)
    columns = columns or docs.columns

    def unlearned(rows: DataFrame) -> DataFrame:
        share = rows.agg(F.avg("label")).first()[0] if without_model is None else without_model
        return docs.select(*columns).withColumn(score_col, F.lit(float(share or 0.0)))

    if chosen.select("label").distinct().count() < 2:
        return unlearned(chosen)
    forms = learn_forms(docs, chosen, id_col, text_col)
    labelled = docs.select(docs[id_col].alias("sample_id"), docs[text_col].alias("text")).join(F.broadcast(chosen), "sample_id")
    rows = with_features(labelled, forms, "text", "features").select(
        "sample_id", "label", array_to_vector("features").alias("features")
    )
    rows = written(rows.repartition(6, "sample_id"), "features")
    held = F.pmod(F.xxhash64("sample_id", F.lit("calibration")), F.lit(5)) == 0
    if rows.select("label", held).distinct().count() < 4:
        return unlearned(rows)
    trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, seed=7, minInstancesPerNode=10).fit(rows.where(~held))
    raw = lambda df, c: trees.setFeaturesCol(c).setPredictionCol("").setProbabilityCol("__chance").setRawPredictionCol("").transform(df)
    chance = lambda df, c: raw(df, c).withColumn("__chance", vector_to_array("__chance")[1])
    steps = IsotonicRegression(featuresCol="__chance", labelCol="label", predictionCol="__score").fit(
        chance(rows.where(held), "features")
    )
    name = free_name(docs.columns, "features")
    found = with_features(docs.select(*dict.fromkeys([*columns, text_col])), forms, text_col, name)
    found = found.select(*columns, array_to_vector(name).alias(name))
    # The model's function gives the same step for the same input on every row.
    calibrated = steps.transform(chance(found, name))
    return calibrated.select(*columns, F.least(F.greatest("__score", F.lit(0.0)), F.lit(1.0)).alias(score_col))
