import pytest

#: Nulls, empty and blank texts, ties, repeated rows, a long text, odd characters.
LONG = " ".join(f"w{n * n % 977}" for n in range(6000))
PASSAGE = " ".join(f"shared{n}" for n in range(60))
TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, "one two"), (6, "One TWO"), (7, LONG), (8, LONG + " end"),
    (9, f"before {PASSAGE} after it"), (10, f"{PASSAGE}"), (11, f"other start {PASSAGE} x{PASSAGE}"),
    (12, "a  b \n cé \U0001f600 café <|endoftext|> d"), (12, "a  b \n cé \U0001f600 café <|endoftext|> d"),
    (None, "no id here"), (13, "ab" * 300), (14, "ab" * 200), (15, "z" * 120 + " tail"), (16, "one"), (17, "日本語" * 40),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd case, over three partitions, and columns that clash with internal names."""
    rows = [(i, t, "x", n, True, "d", 0) for n, (i, t) in enumerate(TEXTS)]
    names = "doc_id long, text string, id string, row int, kept boolean, digest string, maybe int"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
