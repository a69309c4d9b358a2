import pytest

SF_DIR = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
DOCS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (2, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (4, "", None, None),
    (5, LONG, "fr", "a"),
    (6, LONG + " end", "fr", "a"),
    (7, "a b c d e a b c d e f\n a b \n\n a b \nz", "de", "é"),
    (None, "text without an id", "de", "b"),
    (8, "\u00a0x\u2003y \x1c z\x0b\x0c\r\t", None, None),
    (9, "x", "xx", None),
    (10, "%%% *** ### $$$ &&& <<>> |||| %% ** ##", "en", "b"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(*r, "x", i, "y", 1.5) for i, r in enumerate(DOCS)]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, digest string, kept int, "
        "carry string, size double",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
