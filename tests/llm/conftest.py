import pytest

#: Nulls in any column, empty and long texts, ties, repeats, texts of white space, odd characters.
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (0, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, "   \t\n ", None, "b"),
    (5, LONG, "de", "a"),
    (6, LONG + " tail", "de", None),
    (7, "a a a a " * 30, "fr", "c"),
    (8, "a a a a " * 30, "fr", "c"),
    (9, "naïve café — 日本語  テキスト <|endoftext|> é", "fr", "é"),
    (10, "one", "en", "a"),
    (None, "one", "en", "a"),
    (11, "One", "en", "a"),
    (12, "double  spaces\n\n\nand\r\nlines\x0b\x0c end ", "en", "b"),
    (13, "12345 67890 !!!", None, "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The edge cases, with a further column whose name clashes with outputs."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as size", "'x' as kept", "length(text) as n_chars")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
