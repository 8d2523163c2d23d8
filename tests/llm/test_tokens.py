import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import packing, token_files, tokens
from tests.llm import brute


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_pieces_and_places(request, name):
    docs = request.getfixturevalue(name)
    texts = brute.pairs(docs)
    expected = sorted((brute.key((i,)), tuple(ids + [0])) for (i, _), ids in zip(texts, brute.token_ids(t for _, t in texts)))
    found = packing.pack(docs)
    pieces = found.collect()
    whole = {}
    for r in sorted(pieces, key=lambda r: r["start"]):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 1024
        whole.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], ids))
    # Rows with one id and length lie over each other: compare all their ids as a bag.
    flat = sorted(x for i, ids in expected for x in ids)
    assert flat == sorted(x for parts in whole.values() for _, ids in parts for x in ids)
    if name == "documents":
        joined = sorted((brute.key((i,)), tuple(x for _, ids in parts for x in ids)) for (i, _), parts in whole.items())
        assert joined == expected
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    joined = {r["sequence_id"]: r for r in packing.sequences(found).collect()}
    assert sum(r["length"] for r in joined.values()) == len(flat)
    assert all(len(r["ids"]) == 4 * r["length"] for r in joined.values())


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_shortest_pack_first_wastes_little():
    rng = random.Random(0)
    histogram = {}
    for _ in range(50_000):
        length = min(1024, int(rng.paretovariate(0.7) * 20))
        histogram[length] = histogram.get(length, 0) + 1
    patterns = packing.shortest_pack_first(histogram)
    placed = {}
    for pattern, count in patterns:
        assert sum(length * copies for length, copies in pattern) <= 1024
        for length, copies in pattern:
            placed[length] = placed.get(length, 0) + copies * count
    assert placed == histogram
    used = sum(length * count for length, count in histogram.items())
    assert used / (1024 * sum(count for _, count in patterns)) > 0.99


def test_cached_ids_are_the_library_s():
    odd = [
        "", " a", "a  b", "a\n b", "a \n b", "\n", " ", "  ", "don't stop 's it's", "x<|endoftext|>y <|endoftext|>",
        "日本 語", "tab\t x", "a\x1c b", "1 22 a1", "\u0085 y", "a b ", "a b  ", "x" * 100 + " " + "y" * 100 + " z",
    ]
    encoder = tokens.UnitCachedEncoder(tokens.default_tokenizer(), entries=3)
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(odd)]
        assert found == brute.token_ids(odd)


def test_added_tokens_get_their_ids():
    from tokenizers import Tokenizer

    texts = [
        "x<|endoftext|>y", "plain words first", "a <|endoftext|> b", "<|endoftext|>", "a  b<|endoftext|> ",
        "y<|endoftext|><|endoftext|>.\n z", "<|endoftext |> plain words", "w" * 100 + " <|endoftext|>",
    ]
    library = Tokenizer.from_file(tokens.default_tokenizer())
    encoder = tokens.UnitCachedEncoder(tokens.default_tokenizer())
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert found[0] == [87, 50256, 88]


ATOMS = [
    "a", "Zz", "word", "it's", "'s", "'", "don't", ".", ",", "...", "!", "1", "42", "\n", "\n\n", " ", "  ", "\t", "\r\n", "\u00a0",
    "\u3000", "\u2028", "\u0085", "\x1c", "\x00", "\x01", "\x0b", "é", "ñandú", "ß.", "日本", "\U0001f600", "ру", "ق", "\u1680", "-", "_",
]


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_random_texts(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 200)
    monkeypatch.setattr(tokens, "UNITS_A_TEXT", 3)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randrange(0, 14))) for _ in range(3000)]
    texts += [" ".join(rng.choice(ATOMS) for _ in range(200)) for _ in range(20)] + ["x" * 500, ("ab " * 30 + "\n") * 9]
    encoder = tokens.UnitCachedEncoder(tokens.default_tokenizer(), entries=300)
    expected = brute.token_ids(texts)
    for _ in range(2):
        for text, ids, want in zip(texts, encoder.encode(texts), expected, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want, text


@pytest.mark.parametrize("name", ["documents", "odd_docs"])
def test_token_files(spark, request, tmp_path, name):
    docs = request.getfixturevalue(name)
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, block_tokens=2000)
    found = token_files.with_start(token_files.read_token_files(spark, path))
    got = sorted(found.collect(), key=lambda r: r["start"])
    texts = sorted(brute.pairs(docs), key=lambda row: (row[0] is not None, row[0] or 0))
    assert [r["doc_id"] for r in got] == [i for i, _ in texts]
    at = 0
    for r, ids in zip(got, brute.token_ids(t for _, t in texts)):
        assert (r["start"], r["n_tokens"]) == (at, len(ids) + 1)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids + [2]
        at += len(ids) + 1


def test_token_files_of_nothing(spark, no_docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(no_docs, path)
    assert token_files.with_start(token_files.read_token_files(spark, path)).count() == 0


@pytest.mark.parametrize("step", [0, 1, 7, 1000, 2**33])
def test_elias_fano(step):
    rng = np.random.default_rng(step % 97)
    values = np.cumsum(rng.integers(0, step + 1, 900)).astype(np.uint64)
    code = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(values).to_bytes())
    assert [code.select(i) for i in range(len(values))] == values.tolist() == code.select(0, len(values)).tolist()
    for _ in range(50):
        a, b = sorted(rng.integers(0, 900, 2).tolist())
        assert code.select(a, b).tolist() == values[a:b].tolist()
    assert len(code.to_bytes()) <= 17 + 2 + 8 * 4 + 900 * (2 + max(1, step).bit_length()) / 8 + 900 / 8
    with pytest.raises(IndexError):
        code.select(900)
    empty = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(values[:0]).to_bytes())
    assert empty.count == 0


def test_the_directory_is_read_from_the_code():
    """Nothing is decoded when a code is opened, and a look-up touches the bytes it needs only."""
    values = np.arange(0, 7 * 100_000, 7)
    data = bytearray(token_files.EliasFano.encode(values).to_bytes())
    code = token_files.EliasFano.from_bytes(bytes(data))
    assert not hasattr(code, "decode") and {k: len(v) for k, v in vars(code).items() if hasattr(v, "__len__")}.keys() == {"_directory", "_low", "_high"}
    high = len(data) - len(code._high)
    data[high + 20_000 : high + 30_000] = bytes(10_000)  # damage far away does no harm
    assert token_files.EliasFano.from_bytes(bytes(data)).select(500, 700).tolist() == values[500:700].tolist()


def test_wide_ids():
    wide = np.array([1, 70_000, 3], "<u4")
    block = token_files.Block(token_files.pack_block(0, 0, [None, 5], [1, 2], wide.tobytes()))
    assert block.ids(0, 2) == [None, 5] and block.bounds(0, 2).tolist() == [0, 1, 3] and block.token_ids(0, 3).tolist() == wide.tolist()
    assert block.ids(1, 2) == [5] and block.ids(0, 1) == [None] and block.token_ids(1, 2).tolist() == [70_000]


def test_rows_without_id_fill_several_ranges(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 8).selectExpr("IF(id % 100 = 0, id, NULL) AS doc_id", "concat('text ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(docs, str(tmp_path / "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = token_files.with_start(token_files.read_token_files(spark, str(tmp_path / "ids")))
    tasks = {r["task"]: r["n"] for r in read.where("doc_id is null").groupBy("task").agg(F.count("*").alias("n")).collect()}
    assert len(tasks) > 2 and max(tasks.values()) < 2000
    got = sorted(read.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 3960 + list(range(0, 4000, 100))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
