import pytest

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with those the operators make."""
    def make(rows):
        full = [(x[0], x[1], x[2] if len(x) > 2 else "en", "s", None, "x", "y", 1, True) for x in rows]
        return spark.createDataFrame(full, DOCS + ", id string, hash string, cls int, kept boolean")
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, ties, one very long text."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(40_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a b"), (6, "A  B"), (7, "The quick brown fox jumps over the lazy dog"),
            (7, "The quick brown fox jumps over the lazy dog"), (8, "the quick  brown fox jumps over the lazy dog"),
            (None, "no id here at all"), (None, "no id here at all"), (9, long), (10, long + " tail"),
            (11, "日本語 のテキスト 😀"), (12, "Été à la MIT License, <|endoftext|> </s> ##"), (13, "x" * 5000)]


@pytest.fixture(scope="session")
def small_texts():
    import duckdb
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SMOKE}/documents.parquet' ORDER BY doc_id").fetchall()
