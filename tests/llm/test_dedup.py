import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import bloom, common, exact_dedup, ngram_join, substring_dedup, suffix_dedup
from ebbtide.llm.graph import components
from ebbtide.llm.words import split_hashes
from tests.llm import brute


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=brute.key)


def near_copies(spark, seed=1, n=60):
    """Originals, mutated copies, copies of copies and a common passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(45)]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 6, 40, 90, 200]))]
        if rng.random() < 0.3:
            words[len(words) // 2 : len(words) // 2] = passage
        out.append(words)
        for _ in range(rng.choice([0, 0, 1, 4, 12])):
            copy = list(rng.choice(out[-4:]))
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(copy)
    texts = [(k, " ".join(words)) for k, words in enumerate(out)]
    rng.shuffle(texts)
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_exact_groups(request, name):
    docs = request.getfixturevalue(name)
    found = exact_dedup.exact_groups(docs)
    assert rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute.exact(brute.pairs(docs)), key=brute.key)
    kept = [r for r in found.collect() if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in found.collect()} ) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_groups_with_a_full_filter(documents):
    few = exact_dedup.exact_groups(documents, max_blocks=1)
    assert rows(few, "doc_id", "keep_id") == rows(exact_dedup.exact_groups(documents), "doc_id", "keep_id")


def test_drop_exact_copies(odd_docs, no_docs):
    kept = exact_dedup.drop_exact_copies(odd_docs)
    assert kept.schema == odd_docs.schema
    assert kept.count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert exact_dedup.drop_exact_copies(no_docs).count() == exact_dedup.exact_groups(no_docs).count() == 0


def test_exact_main_path_is_native(documents):
    plan = exact_dedup.exact_groups(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_similar_sets(request, name):
    docs = request.getfixturevalue(name)
    found = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)


@pytest.mark.parametrize("frequent", [None, 0])
def test_near_copies_are_linked(spark, monkeypatch, frequent):
    if frequent is not None:  # every token is frequent: only pairs are signatures
        original = ngram_join._sets
        monkeypatch.setattr(ngram_join, "_sets", lambda t, l, f, s, p: original(t, l, frequent, s, p))
    docs = near_copies(spark)
    found = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)


def test_signatures_are_shared_by_all_similar_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(2, 120))
        x = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
        y = x.copy()
        for _ in range(int(rng.integers(0, 1 + len(x) // 8))):
            y[rng.integers(len(y))] = rng.integers(1, 2**63)
        y = np.unique(y[rng.random(len(y)) > rng.choice([0, 0.05, 0.1])]) if len(y) > 3 else y
        common = len(np.intersect1d(x, y))
        if not len(y) or 100 * common < 80 * (len(x) + len(y) - common) or np.array_equal(x, y):
            continue
        levels = {t: int(rng.integers(0, 20)) for t in np.union1d(x, y).tolist()}
        of = lambda s: np.array([levels[t] for t in s.tolist()], np.uint8)
        for frequent in (0, 5, 10, 30):
            (a, rest_a), (b, rest_b) = (ngram_join.signatures(s, of(s), frequent, 80) for s in (x, y))
            shared, at_a, at_b = np.intersect1d(a, b, return_indices=True)
            assert len(shared) and np.minimum(rest_a[at_a], rest_b[at_b]).max() >= common


def test_drop_similar(odd_docs, no_docs):
    kept = ngram_join.drop_similar(odd_docs)
    assert kept.schema == odd_docs.schema
    expected = [i for (i, _, c) in brute.components(brute.pairs(odd_docs)) if i is None or i == c]
    assert rows(kept, "doc_id") == sorted([(i,) for i in expected], key=brute.key)
    assert ngram_join.drop_similar(no_docs).count() == 0


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100 + k, 101 + k) for k in range(30, 0, -1)] + [(200, 201), (201, 200)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert {roots[k] for k in range(41)} == {0} and {roots[100 + k] for k in range(1, 32)} == {101} and roots[201] == 200


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_suffix_removal(request, name):
    docs = request.getfixturevalue(name)
    found = suffix_dedup.removal(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("sha")
    )
    assert rows(found, *found.columns) == sorted(brute.byte_repeats(brute.pairs(docs)), key=brute.key)


def test_suffix_removal_of_near_copies(spark, no_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH_BYTES", 3000)
    docs = near_copies(spark, seed=5)
    found = suffix_dedup.removal(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("sha")
    )
    assert rows(found, *found.columns) == sorted(brute.byte_repeats(brute.pairs(docs)), key=brute.key)
    assert suffix_dedup.removal(no_docs).count() == 0


@pytest.mark.parametrize("letters", [2, 5, 200])
def test_two_stage_order(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 30, 700):
        data = np.concatenate([rng.integers(1, letters + 1, n), [0]]).astype(np.uint8)
        order = suffix_dedup.two_stage_order(data, n + 8)
        text = data.tobytes()
        assert order.tolist() == sorted(range(n + 1), key=lambda k: text[k:])


def test_two_stage_order_groups_equal_strings():
    data = np.frombuffer(b"a" * 90 + b"b" + b"a" * 70 + b"\1" + b"ab" * 60 + b"a" * 60 + b"\0", np.uint8)
    order = suffix_dedup.two_stage_order(data, 50)
    heads = [data.tobytes()[k : k + 50] for k in order.tolist()]
    assert heads == sorted(heads)


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_substring_removal(request, name):
    docs = request.getfixturevalue(name)
    found = substring_dedup.removal(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    assert rows(found, *found.columns) == sorted(brute.word_repeats(brute.pairs(docs)), key=brute.key)


def test_substring_removal_of_near_copies(spark, no_docs):
    docs = near_copies(spark, seed=7)
    found = substring_dedup.removal(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    assert rows(found, *found.columns) == sorted(brute.word_repeats(brute.pairs(docs)), key=brute.key)
    assert substring_dedup.removal(no_docs).count() == 0


def thue_morse(size, letters=b"ab"):
    return bytes(letters[k.bit_count() % 2] for k in range(size)).decode()


@pytest.mark.parametrize("size", [512, 1024, 2048, 8192])
def test_periodic_words_that_differ_stay_apart(spark, size):
    """Polynomials modulo 2^64 give these words one hash, whatever the base."""
    one, other = thue_morse(size), thue_morse(size, b"ba")
    assert len({int(split_hashes([w.encode()])[0][0]) for w in (one, other)}) == 2
    rest = " ".join(f"v{k}" for k in range(34))
    docs = spark.createDataFrame(
        [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} a b c"), (4, f"{other} a b c")], "doc_id long, text string"
    )
    found = substring_dedup.removal(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    assert rows(found, *found.columns) == sorted(brute.word_repeats(brute.pairs(docs)))
    similar = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert similar == sorted(brute.components(brute.pairs(docs)))


def test_word_hashes_follow_the_words():
    rng = random.Random(8)
    unit = lambda: bytes(rng.choice(b"abAB") for _ in range(rng.randrange(1, 9)))
    words = [unit() * rng.choice([1, 2, 64, 128, 512]) + unit() * rng.choice([0, 1, 700]) for _ in range(3000)]
    texts = [b" \t".join(words[k : k + 7]) for k in range(0, len(words), 7)]
    for lower in (False, True):
        plain = [(t.lower() if lower else t).split() for t in texts]
        found = split_hashes(texts, lower)
        names, back = {}, {}
        for text, ws, hs in zip(texts, plain, found):
            assert len(ws) == len(hs) and (split_hashes([text], lower)[0] == hs).all()
            for w, h in zip(ws, hs.tolist()):
                assert names.setdefault(w, h) == h and back.setdefault(h, w) == w
        whole = split_hashes([b" ".join(texts)], lower)[0]
        assert whole.tolist() == [names[w] for ws in plain for w in ws]


@pytest.mark.parametrize("letters", [2, 3, 200])
def test_two_stage_order_sorts_only_what_is_wanted(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 30, 700):
        data = np.concatenate([rng.integers(1, letters + 1, n), [0]]).astype(np.uint8)
        whole = suffix_dedup.two_stage_order(data, n + 8)
        for share in (0, 0.05, 0.5, 1):
            wanted = rng.random(n + 1) < share
            order = suffix_dedup.two_stage_order(data, n + 8, wanted)
            assert order.tolist() == [k for k in whole.tolist() if wanted[k]]


def test_suffixes_that_run_over_an_end_are_not_sorted(monkeypatch):
    """Of contexts of 74 bytes, 25 suffixes are long enough; the others are sorted where they induce one."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, 74).astype(np.uint8).tobytes() for _ in range(300)]
    texts += [b"XY" + text[3:60] + b"ZZZ" for text in texts[:100]]
    sorted_, original = [], suffix_dedup._direct_order
    monkeypatch.setattr(suffix_dedup, "_direct_order", lambda d, s, n: sorted_.append(len(s)) or original(d, s, n))
    found = suffix_dedup.repeated_strings(texts, np.arange(len(texts)))
    assert set(zip(*map(np.ndarray.tolist, found))) == {(300 + t, 2 + k) for t in range(100) for k in range(8)}
    assert sum(sorted_) < 0.3 * sum(map(len, texts))


def chosen_sets(spark, docs, monkeypatch):
    """Runs the join; what it handed on for comparison: rows of whole sets, and member rows."""
    seen = {"sets": [], "members": [], "kinds": []}
    token_sets, shared = ngram_join._token_sets, ngram_join._shared

    def watched(*args):
        sets, rows = token_sets(*args)
        seen["sets"].append((sets._jdf.queryExecution().toString(), rows.count(), rows.select("node").distinct().count()))
        return sets, rows

    def members(*args):
        found = shared(*args)
        seen["members"] += found.select("signature", "node", "n").collect()
        return found

    monkeypatch.setattr(ngram_join, "_token_sets", watched)
    monkeypatch.setattr(ngram_join, "_shared", members)
    found = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    return found, seen


def test_whole_sets_are_told_apart_without_a_shuffle(spark, monkeypatch):
    docs = near_copies(spark, seed=11)
    docs = docs.unionByName(docs).repartition(4)  # every node stands in several rows
    found, seen = chosen_sets(spark, docs, monkeypatch)
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)
    assert seen["sets"]
    for plan, n, distinct in seen["sets"]:
        assert "Exchange" not in plan and n == distinct


def test_members_that_cannot_link_are_left_out(spark, monkeypatch):
    """Two sets that share a shingle by which they cannot link: one is far larger than the other."""
    passage = " ".join(f"p{k}" for k in range(5))
    large = " ".join(f"l{k}" for k in range(300))
    near = [f"n{k}" for k in range(100)]
    texts = [(k, f"{passage.replace('p', f'p{k}x')} s{k} t{k}") for k in range(20)]
    texts += [(100 + k, f"{passage.replace('p', f'p{k}x')} {large.replace('l', f'l{k}x')}") for k in range(20)]
    texts += [(200, " ".join(near)), (201, " ".join([*near[:99], "other"]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found, seen = chosen_sets(spark, docs, monkeypatch)
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)
    assert {r["n"] for r in seen["members"]} == {96}


def test_memory_goes_back_at_the_end_of_a_task(monkeypatch):
    import pyarrow as pa

    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append("released")})()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    assert list(common.releasing(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4] and calls == ["released"]


def test_rows_go_to_python_workers_in_small_batches(spark):
    """Batches of a written table are bounded in bytes, one row at least; a session's own bound stays."""
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    def written_sizes(rows):
        found = common.written(common.arrow_map(rows, sizes, "n long"), "sizes").collect()
        assert sum(r["n"] for r in found) == rows.count()
        return max(r["n"] for r in found)

    texts = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("text"))
    assert spark.conf.get(common.ARROW_BYTES, None) is None
    assert written_sizes(texts) * 50_000 <= common.BATCH_BYTES + 50_000
    assert written_sizes(spark.range(0, 3, 1, 1).select(F.repeat(F.lit("x"), 5_000_000))) == 1
    assert spark.conf.get(common.ARROW_BYTES, None) is None
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        1 / 0
    assert spark.conf.get(common.ARROW_BYTES, None) is None
    spark.conf.set(common.ARROW_BYTES, 100_000)
    try:
        assert written_sizes(texts) <= 2 and spark.conf.get(common.ARROW_BYTES) == "100000"
    finally:
        spark.conf.unset(common.ARROW_BYTES)


def test_words_of_many_texts_are_hashed_together(monkeypatch):
    """Windows are those of each text; the hashing is called for groups of texts, not for each."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 17, 18, 34, 35, 36, 90]))).encode() for _ in range(200)]
    some, plain = substring_dedup.Words(texts), [text.split() for text in texts]
    for size in (18, 35):
        starts = [(t, k) for t, words in enumerate(plain) for k in range(len(words) - size + 1)]
        at = np.flatnonzero(some.inside(size))
        assert list(zip(some.text[at].tolist(), some.offset[at].tolist())) == starts
        alone = np.concatenate([substring_dedup.stretches(words, size) for words in split_hashes(texts)])
        assert (substring_dedup.stretches(some.words, size)[at] == alone).all()
        blocks = np.flatnonzero(some.blocks(size))
        assert list(zip(some.text[blocks].tolist(), some.offset[blocks].tolist())) == [s for s in starts if s[1] % size == 0]


def test_filters_follow_the_number_of_keys(spark, monkeypatch):
    """A filter over few keys is small; whatever its size, no key is missed, a null one included."""
    sizes, original = [], bloom.filter_blocks

    def watched(*args):
        found = original(*args)
        sizes.append(found.selectExpr("sum(length(bits))").first()[0] or 0)
        return found

    monkeypatch.setattr(bloom, "filter_blocks", watched)
    rows_ = spark.range(30_000).select(F.when(F.col("id") > 0, F.col("id")).alias("key"))
    for n in (0, 1, 700, 20_000):
        found = bloom.marked(rows_, "key", rows_.where(F.coalesce("key", F.lit(0)) < n))
        assert found.where(~F.col("maybe") & (F.coalesce("key", F.lit(0)) < n)).count() == 0
        assert found.where("maybe").count() <= n + 0.02 * 30_000
    assert sizes[0] == 0 and max(sizes) <= 512 * 1024


def test_sets_travel_as_packed_texts(spark, monkeypatch):
    """What is shuffled for a comparison is smaller than the hashes of the sets."""
    sizes, token_sets = [], ngram_join._token_sets

    def watched(*args):
        packed, rows_ = token_sets(*args)
        sizes.append(packed.selectExpr("sum(length(text))").first()[0])
        return packed, rows_

    monkeypatch.setattr(ngram_join, "_token_sets", watched)
    rng = random.Random(4)
    words = [[rng.choice(["of", "data", "language", "training", "é\x00 Model"]) for _ in range(3000)] for _ in range(4)]
    texts = [(10 * k + c, " ".join(["Copy", str(c), *own])) for k, own in enumerate(words) for c in range(3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)
    assert 0 < sizes[0] < 0.5 * sum(8 * n for _, n, _ in found)


def test_rounds_without_pairs_verify_nothing(spark, monkeypatch):
    pairs, links_of = [], ngram_join._links_of

    def watched(some, *args):
        pairs.append(some.count())
        return links_of(some, *args)

    monkeypatch.setattr(ngram_join, "_links_of", watched)
    docs = near_copies(spark, seed=5)
    found = rows(ngram_join.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(brute.pairs(docs)), key=brute.key)
    assert all(pairs)


def test_counters_of_any_width(spark):
    """Cells are sent as narrow as their counts allow, and add up over tasks."""
    texts = [(k, f"one two three four five{' x y z v w' if k % 3 else ''}") for k in range(70_000)] + [(-1, "some other words stand here")]
    docs = spark.createDataFrame(texts, "id long, text string").repartition(3)
    found = ngram_join._counters(docs, 5)
    assert sorted(found[found > 0].tolist()) == [1, *[46_666] * 5, 70_000]


@pytest.mark.parametrize("shift, size", [(54, 4 * 1024), (36, 32 * 1024), (50, 4 * 16_384)])
def test_filters_over_hashes_come_in_pieces(spark, monkeypatch, shift, size):
    """Few bits come as their places, many as they are, some bytes at a time; none is missing or false."""
    sizes, fetched, original, collect = [], [], bloom.written, type(spark.range(0)).collect

    def watched(*args):
        found = original(*args)
        sizes.append(found.selectExpr("sum(length(bits))").first()[0] or 0)
        return found

    def collected(frame):
        got = collect(frame)
        fetched.append(sum(len(r["bits"]) for r in got) if "bits" in frame.columns else 0)
        return got

    monkeypatch.setattr(bloom, "written", watched)
    monkeypatch.setattr(bloom, "FETCH_BYTES", 1000, raising=False)
    monkeypatch.setattr(type(spark.range(0)), "collect", collected)
    n = 1024 if shift == 54 else 16_384  # in 1,024 buckets; in one; in 1,024 with 16 each
    keys = spark.range(n).selectExpr(f"shiftleft(id, {shift}) AS key").repartition(3)
    found = bloom.hash_filter(keys.unionByName(keys), lambda batches: (b.column(0).to_numpy().view(np.uint64) for b in batches), least=2)
    held = found.value
    assert held.may_hold(np.arange(n, dtype=np.uint64) << np.uint64(shift)).all()
    assert np.unpackbits(held.data[held.data > 0]).sum() == n
    assert sizes == [size] and sum(fetched) == size
    assert max(fetched) <= (32 * 1024 if shift == 36 else 1000)
    none = bloom.hash_filter(keys, lambda batches: (b.column(0).to_numpy().view(np.uint64) for b in batches), least=2)
    assert not none.value.data.any() and sizes[1:] == [0]
