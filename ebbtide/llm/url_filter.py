"""URL filters: host and path rules, then naive Bayes over words segmented from hosts and paths.

Rules block or allow a host with its subdomains and a path prefix; the longest that fits decides.
The other urls are judged by multinomial naive Bayes, trained on the urls that the rules decide:
tokens are the words of the host and of the path.

Hosts run words together. A unigram model splits them: words and counts come from the visible
text of all pages, each distinct host part is cut at every place into pieces of every length that a
counted word has, the pieces meet their counts in a join, and the Viterbi path over the pieces is the segmentation. All
of it is keyed by host part, of which there are far fewer than pages; no vocabulary is broadcast.
Scores are computed once per pair of host and path words and joined back to the pages.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and the
verdict of the prior; repeated rows are judged alike; null ids are kept; without trained urls the
verdict is ``allow``; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import LOWER, UPPER, arrow_map, written

_TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rule:
    action: str  # "allow" or "block"
    host: str
    path: str  # with its leading slash

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url as text, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct of text and action, or null."""
    ordered = sorted(rules, key=lambda rule: -len(rule.text))
    cases = [
        F.when(rule.fits(host, path), F.struct(F.lit(rule.text).alias("text"), F.lit(rule.action).alias("action")))
        for rule in ordered
    ]
    return F.coalesce(*cases) if cases else F.lit(None).cast("struct<text:string,action:string>")


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """word, n over the visible text of all pages."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for html in batch.column(0):
                found.update(_WORDS.findall(_TAG.sub(" ", html.as_py() or "").lower()))
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    counted = arrow_map(pages.select(pages[html_col].cast("string").alias("html")), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def segmented(parts_: DataFrame, counts: DataFrame) -> DataFrame:
    """part, words: every distinct part split by the most likely path through known words."""
    import pyarrow as pa

    counts = written(counts, "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 1
    size = F.length("part")
    longest = parts_.agg(F.max(size)).first()[0] or 0
    # Single letters need no count: they carry a part over what no word covers.
    lengths = counts.select(F.length("word").alias("letters")).where(F.col("letters").between(2, longest)).distinct().collect()
    of_words = F.array(*[F.lit(n) for n in sorted(r["letters"] for r in lengths)]).cast("array<int>")
    pieces = (
        parts_.select("part").distinct()
        .select("part", F.explode(F.sequence(F.lit(1), size)).alias("start"))
        .select("part", "start", F.explode(F.filter(of_words, lambda n: n <= size - F.col("start") + 1)).alias("letters"))
        .select("part", "start", "letters", F.expr("substring(part, start, letters)").alias("word"))
    )
    known = pieces.join(counts, "word")
    graph = known.groupBy("part").agg(F.collect_list(F.struct("start", "letters", "n")).alias("edges"))
    whole = parts_.select("part").distinct().join(graph, "part", "left")
    unknown = -math.log(total) - math.log(10)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                viterbi(part, [(e["start"] - 1, e["letters"], math.log(e["n"] / total)) for e in edges or ()], unknown)
                for part, edges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["part", "words"])

    return written(arrow_map(whole, split, "part string, words array<string>"), "segmented")


def viterbi(part: str, edges: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """The best words for ``part``; ``edges`` are (start, length, log probability), a letter without one costs ``unknown``."""
    steps: dict[int, list[tuple[int, float]]] = {}
    for start, length, cost in edges:
        steps.setdefault(start, []).append((length, cost))
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(part)
    for start in range(len(part)):
        for length, cost in [(1, unknown), *sorted(steps.get(start, ()))]:
            if best[start][0] + cost > best[start + length][0]:
                best[start + length] = (best[start][0] + cost, start)
    words, end = [], len(part)
    while end:
        words.append(part[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


def _tokens(text: Column) -> Column:
    """Runs of letters, and ``#`` for each run of digits."""
    plain = F.regexp_replace(F.lower(text), r"\p{Nd}+", " # ")
    return F.filter(F.split(F.regexp_replace(plain, r"[^\p{L}#]+", " "), " "), lambda word: word != "")


def judged(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score (log odds of block; null where a rule decides)."""
    host, path = parts(pages[url_col].cast("string"))
    urls = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "path_words", F.concat_ws(" ", _tokens(F.col("path")))
    )
    urls = written(urls, "urls")
    pairs = written(
        urls.groupBy("host", "path_words", F.col("hit.action").alias("action")).agg(F.count(F.lit(1)).alias("n")), "url-pairs"
    )
    hosts = pairs.select("host").distinct()
    host_parts = hosts.select("host", F.posexplode(_tokens(F.col("host"))).alias("place", "part"))
    words = segmented(host_parts, word_counts(pages, html_col))
    host_words = (
        host_parts.join(words, "part")
        .groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda p: p["words"])).alias("words"))
    )
    both = pairs.join(written(host_words, "host-words"), "host", "left")
    tag = lambda kind, array: F.transform(array, lambda word: F.concat(F.lit(kind), word))
    path_array = F.filter(F.split("path_words", " "), lambda word: word != "")
    tokens = F.concat(tag("host:", F.coalesce("words", F.array().cast("array<string>"))), tag("path:", path_array))
    both = written(both.select("host", "path_words", "action", "n", tokens.alias("tokens")), "url-tokens")

    is_block = F.when(F.col("action") == "block", F.col("n")).otherwise(0)
    trained = both.where("action is not null").withColumn("blocked", is_block).withColumn("allowed", F.col("n") - is_block)
    counts = written(
        trained.select(F.explode("tokens").alias("token"), "blocked", "allowed").groupBy("token").agg(
            F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")
        ),
        "token-counts",
    )
    sums = counts.agg(F.sum("blocked"), F.sum("allowed"), F.count(F.lit(1))).first()
    prior = trained.agg(F.sum("blocked"), F.sum("allowed")).first()
    block_sum, allow_sum, vocabulary = sums[0] or 0, sums[1] or 0, sums[2] + 1
    unseen = math.log((allow_sum + vocabulary) / (block_sum + vocabulary))
    weights = counts.select("token", (F.log((F.col("blocked") + 1) / (F.col("allowed") + 1)) + unseen).alias("weight"))
    start = math.log(((prior[0] or 0) + 1) / ((prior[1] or 0) + 1))

    key = ["host", "path_words"]
    distinct = both.select(*key, "tokens").distinct()
    scores = (
        distinct.select(*key, F.explode_outer("tokens").alias("token"))
        .join(written(weights, "token-weights"), "token", "left")
        .groupBy(*key)
        .agg((F.lit(start) + F.sum(F.when(F.col("token").isNull(), 0.0).otherwise(F.coalesce("weight", F.lit(unseen))))).alias("score"))
    )
    found = urls.join(written(scores, "url-scores"), key, "left")
    method = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.text").alias("rule"),
        F.coalesce(F.col("hit.action"), method).alias("verdict"),
        F.when(F.col("hit").isNull(), F.col("score")).alias("score"),
    )
