"""Decontamination, toxicity, URL filters, WARC and the pipeline."""

import base64
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from ebbtide.llm import decontaminate, toxicity, url_filter, warc
from ebbtide.llm.queries import URL_RULES, operator_queries, operator_statements
from ebbtide.llm.words import letters_and_digits
from tests.llm import brute


def normal(text):
    return [w for w in map(letters_and_digits, (text or "").split()) if w]


def plain_leaks(docs, items):
    found = set()
    for d, text in docs:
        words = normal(text)
        for i, item in items:
            want = normal(item)
            window = min(13, len(want))
            for shift in range(-len(want), len(words)) if len(want) >= 5 else ():
                same = [0 <= p + shift < len(words) and words[p + shift] == w for p, w in enumerate(want)]
                inside = [0 <= p + shift < len(words) for p in range(len(want))]
                if any(
                    all(inside[k : k + window]) and 100 * sum(same[k : k + window]) >= 80 * window
                    for k in range(len(want) - window + 1)
                ):
                    found.add((d, i))
    return found


def leak_cases(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(80)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([3, 5, 7, 10, 12, 13, 14, 20, 40, 20])]
    items += [(90, None), (91, ""), (92, items[7][1]), (None, items[6][1] + " more")]
    docs = []
    for k in range(90):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 20, 60]))]
        for _ in range(rng.choice([0, 1, 2])):
            piece = (rng.choice(items)[1] or "").split()
            piece = piece[rng.choice([0, 0, 1, 4]) :]
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                if piece:
                    piece[rng.randrange(len(piece))] = rng.choice(["other", "Words!"])
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in piece]
        docs.append((k, " ".join(words)))
    docs += [(None, items[8][1]), (100, None), (101, "")]
    return docs, items


def test_leaks_equal_brute_force(spark):
    docs, items = leak_cases(spark)
    left = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int").repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 30):
        found = decontaminate.find_leaks(left, right, block_words=block_words)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == plain_leaks(docs, items)
    kept = decontaminate.drop_leaks(left, right, block_words=30)
    gone = [d for d, _ in plain_leaks(docs, items)]
    assert kept.schema == left.schema
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs if d not in gone}
    assert decontaminate.find_leaks(left, right.limit(0)).count() == 0
    assert decontaminate.drop_leaks(left, right.limit(0)).count() == len(docs)
    assert decontaminate.find_leaks(left.limit(0), right).count() == 0


def test_blocks_are_released_one_by_one(spark):
    docs, items = leak_cases(spark)
    left = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, digest int").repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop_leaks(left, right, block_words=100)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()  # no block waits in the plan
    gone = {d for d, _ in plain_leaks(docs, items)}
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(d or -1 for d, _ in docs if d not in gone)


def test_masks_survive_any_two_substitutions():
    for gone in itertools.combinations(range(decontaminate.WINDOW), 2):
        assert any(
            not {p + shift for p in mask} & set(gone)
            for mask in decontaminate.MASKS for shift in range(decontaminate.WINDOW - mask[-1])
        )


def test_planted_benchmark_items_are_found(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {(r["doc_id"], r["item_id"]) for r in operator_queries()["op2_decontamination"](spark, sf_dir).collect()}
    whole = {(d, i) for d, text in docs for i, item in items if " ".join(map(bytes.decode, normal(item))) in " ".join(map(bytes.decode, normal(text)))}
    assert whole and whole <= found


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = operator_queries()["op6_toxicity"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert found.count() == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_toxicity_features():
    reader = toxicity.Reader((("grumble*", 2.0), ("blorp", 3.0)))
    of = lambda text: dict(zip(toxicity.FEATURES, reader.features(text)))
    assert set(of(None).values()) == set(of(" \n").values()) == {0.0}
    assert of("you are an idiot")["hits"] == 1 and of("you are an idiot")["addressed_per_100"] == 25
    assert of("an 1d10t and an i.d.i.o.t and stuuupid")["disguised_per_100"] > 0
    assert of("s c u m here")["hits"] == 1
    assert of("grumbled blorp")["weighted"] == 2 and of("SHOUTED words!")["shouted_words"] == 0.5
    assert of("a calm sentence")["hits"] == 0


def test_plain_words_share_one_entry():
    reader = toxicity.Reader((("grumble*", 2.0),))
    assert reader.features("a calm, quiet sentence. (x) 4 3,5 sooo")[0] == 0
    assert len({id(kind) for kind in reader._known.values()}) == 1 and len(reader._known) == 8
    assert [reader._new(w)[:2] for w in ("_Idiot_", "!d!0t", "iddddiot", "i-d-1-o-t", "$hit", "y.o.u", "grumbling")] == [
        (reader.TOXIC, "idiot"), (reader.DISGUISED, "idiot"), (reader.DISGUISED, "idiot"), (reader.DISGUISED, "idiot"),
        (reader.DISGUISED, "shit"), (reader.ADDRESS, "y.o.u"), (reader.PLAIN, ""),
    ]


def test_worker_keeps_no_words_after_its_task(spark):
    forms = (("grumble*", 2.0),)
    docs = spark.createDataFrame([(k, f"some words {k} here") for k in range(200)], "doc_id long, text string").coalesce(1)

    def known(batches):
        import pyarrow as pa

        list(batches)
        yield pa.RecordBatch.from_arrays([pa.array([len(toxicity._reader(forms)._known)], pa.int64())], names=["n"])

    assert toxicity.with_features(docs, forms, "text", "features").agg(F.max("features")).count() == 1
    assert [r["n"] for r in docs.mapInArrow(known, "n long").collect()] == [0]


def test_every_learned_form_is_kept(spark):
    letters = "abcdefghij"
    vocabulary = [f"{a}{b}{c}" for a in letters for b in letters for c in letters][:600]
    rows = [(k, " ".join([*vocabulary, f"n{k}"]), 1.0) for k in range(20)] + [(k, f"calm text {k}", 0.0) for k in range(20, 60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    chosen = spark.createDataFrame([(r[0], r[2]) for r in rows], "sample_id long, label double")
    forms = dict(toxicity.learn_forms(docs, chosen, "doc_id", "text"))
    assert set(vocabulary) <= set(forms)


def test_toxicity_without_usable_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    yes = F.lit(True)
    assert {r["score"] for r in toxicity.scored(odd_docs, none.limit(0), yes).collect()} == {0.0}
    assert toxicity.scored(odd_docs, none.where("toxic is null"), yes).count() == odd_docs.count()
    assert toxicity.scored(no_docs, none, yes).count() == 0


@pytest.mark.parametrize("kind", [0, 1])
def test_labels_of_one_kind_reject_nothing(spark, odd_docs, tmp_path, kind):
    usable = [(k, kind) for k in range(4, 18)] + [(1, None), (999, 1 - kind)]  # no document has the id 999
    for n, labels in enumerate((usable, usable[:-1])):
        sf_dir = str(tmp_path / str(n))
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
        assert corpus_pipeline.toxic_documents(spark, odd_docs, sf_dir).count() == odd_docs.count()
        scores = toxicity.scored(odd_docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert {r["score"] for r in scores.collect()} == {float(kind)}


def test_toxicity_with_odd_rows(spark, odd_docs):
    bad = [(100 + k, "you idiot moron scum " * (k % 3 + 1), "x", k, True, "d", 0) for k in range(20)]
    good = [(200 + k, f"a calm sentence number {k} about gardens", "x", k, True, "d", 0) for k in range(60)]
    docs = odd_docs.unionByName(spark.createDataFrame(bad + good, odd_docs.schema))
    labels = spark.createDataFrame([(r[0], int(r[0] < 200)) for r in bad + good] + [(None, 1), (1, None)], "doc_id long, toxic int")
    found = toxicity.scored(docs, labels, F.lit(True)).collect()
    assert len(found) == docs.count() and all(r["score"] is not None for r in found)
    assert min(r["score"] for r in found if r["text"] and "idiot" in r["text"]) > max(r["score"] for r in found if r["text"] and "calm" in r["text"])


URLS = [
    (1, None), (2, "no scheme here"), (3, "HTTP://Foo.Example.NET/en/1?x=/y"), (4, "https://example.net/fr/"),
    (5, "http://example.net"), (6, "https://a.example.com/de/x#y"), (7, "https://x.org/fr/"), (8, "https://x.org/FR/"),
    (9, "ftp://net/?a://b"), (10, "https://notnet/de/"), (11, "https://ÄÖ.net/p/ä?q"), (12, "https://cheap-pills.example.com/en/5"),
    (13, "https://cheap-pills.example.com/en/5"), (None, "https://user@h.net:80/a/b;c"), (14, "://"), (15, "https://" + "ab" * 200 + ".com/"),
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best


def test_urls(spark):
    rows = [(i, u, "<p>cheap pills and cheap words</p><script>no</script>", "x") for i, u in URLS]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    found = url_filter.judged(pages, URL_RULES).collect()
    assert len(found) == len(URLS)
    expected = {i: plain_url(u) for i, u in URLS}
    for r in found:
        host, path, rule = expected[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.text)
        assert r["verdict"] == rule.action if rule else r["verdict"] in ("allow", "block")
    assert url_filter.judged(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judged(pages, []).collect()} == {"allow"}
    words = url_filter.segmented(
        spark.createDataFrame([("cheappills",), ("pillsxcheap",), ("",)], "part string"), url_filter.word_counts(pages, "html")
    )
    assert {r["part"]: r["words"] for r in words.collect()} == {"cheappills": ["cheap", "pills"], "pillsxcheap": ["pills", "x", "cheap"], "": []}


def test_long_compounds_stay_whole(spark):
    compound = "donaudampfschifffahrtsgesellschaft"
    pages = spark.createDataFrame([(1, f"<p>{compound} donau dampf schifffahrt</p>")], "page_id long, html string")
    parts = spark.createDataFrame([(f"x{compound}",), (compound,), ("donaudampf",)], "part string")
    words = url_filter.segmented(parts, url_filter.word_counts(pages, "html"))
    assert {r["part"]: r["words"] for r in words.collect()} == {
        f"x{compound}": ["x", compound], compound: [compound], "donaudampf": ["donau", "dampf"]
    }


def test_viterbi_prefers_the_likelier_split():
    edges = [(0, 2, -1.0), (2, 2, -1.0), (0, 4, -3.0), (1, 3, -0.1)]
    assert url_filter.viterbi("abcd", edges, -5.0) == ["ab", "cd"]
    assert url_filter.viterbi("xy", [], -5.0) == ["x", "y"]


PAYLOADS = [
    (1, "http://a", "<html>one</html>"), (2, None, None), (3, "http://b\r\nx", ""), (4, "c", "<html>one</html>"),
    (5, "d", "text WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n more"),
    (6, "e", "WARC/1.WARC/1.1\r\n\r\n" * 40), (7, "f", "é\r\n\r\nWARC/1.0"), (8, "g", "x" * 3000), (9, "h", "x" * 3000), (None, "i", "x" * 3000),
]


@pytest.mark.parametrize("compression, split", [("gzip", None), ("none", None), ("none", "700")])
def test_warc_round_trip(spark, tmp_path, compression, split):
    pages = spark.createDataFrame([(*p, 1) for p in PAYLOADS], "page_id long, url string, html string, digest int").repartition(2)
    path = str(tmp_path / "warc")
    warc.write_warc(pages, path, compression=compression)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = warc.read_warc(spark, path).withColumn("id", warc.page_number(F.col("record_id"))).withColumn("to", warc.page_number(F.col("refers_to"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {r["id"]: r for r in rows}
    assert len(rows) == len(PAYLOADS)
    first = {}
    for i, _, text in sorted(PAYLOADS, key=lambda p: (p[0] is None, p[0])):
        data = (text or "").encode()
        r, start = got[i], first.setdefault(data, i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r["payload_bytes"], r["digest"]) == (len(data), f"sha1:{digest}")
        if start == i:
            assert (r["record_type"], r["to"], bytes(r["payload"])) == ("response", None, data)
        else:
            assert (r["record_type"], r["to"], r["payload"]) == ("revisit", start, None)


def test_warc_of_nothing_and_damage(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(empty, str(tmp_path / "none"), compression="none")
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "v", "defg")], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "one"), compression="none")
    (part,) = [p for p in (tmp_path / "one").glob("part-*") if p.stat().st_size]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "part-0").write_bytes(part.read_bytes()[:-9])
    with pytest.raises(ValueError):
        warc.read_warc(spark, str(tmp_path / "cut"))


def test_small_payloads_need_not_be_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "v", "abc"), (3, "w", "long enough"), (4, "x", "long enough")], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "w"), min_revisit_bytes=5)
    kinds = {warc_id: kind for warc_id, kind in warc.read_warc(spark, str(tmp_path / "w")).select(warc.page_number(F.col("record_id")), "record_type").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_pipeline_keeps_columns_and_clean_documents(spark, sf_dir, documents):
    docs = documents
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.schema == documents.schema
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "exact_dedup":
            assert after == {keep for _, keep, _, _ in brute.exact(before)}
        if name == "ngram_join":
            assert after == {i for i, _, c in brute.components(before) if i == c}
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            exact = {d for d, t in before for _, i in items if " ".join(map(bytes.decode, normal(i))) in " ".join(map(bytes.decode, normal(t)))}
            assert exact and not exact & after
        seen.append(len(after))
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    total = sum(len(ids) + 1 for ids in brute.token_ids(r["text"] for r in docs.collect()))
    assert pieces.agg(F.sum("length")).first()[0] == total
    assert contract.queries()["pipeline"](spark, sf_dir).count() == pieces.count()


def test_registered_queries():
    names = set(contract.queries())
    assert {name.split("_")[0] for name in operator_queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(operator_queries()) <= names and "pipeline" in names
    assert set(operator_statements()) <= set(operator_queries())


@pytest.mark.parametrize("name", sorted(operator_statements()))
def test_query_equals_sql(spark, sf_dir, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = db.sql(operator_statements()[name])
    found = operator_queries()[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(expected.fetchall())


def test_overlap_is_measured_in_words():
    block = decontaminate.Block([(7, np.arange(1, 31, dtype=np.uint64))])
    words = np.concatenate([np.full(5, 99, np.uint64), np.arange(4, 25, dtype=np.uint64)])
    assert block.leaks(words) == {0: (4, 2, 22, 21)} or block.leaks(words)[0][3] == 21
