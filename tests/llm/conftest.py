import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, line + "\n" + line, "en", "a", 7, "x", True),
        (1, line + "\n" + line, "en", "a", 7, "x", True),
        (2, line, None, None, None, None, None),
        (3, None, "en", "a", None, "y", False),
        (4, "", "en", None, 0, "z", None),
        (None, "Café 中文 " + line, "fr", "b", 3, "w", True),
        (None, None, None, None, None, None, None),
        (5, "word " * 30_000, "en", "b", 9, "long", True),
        (6, " \t\n\x0b\n ", "de", "c", 1, "blank", True),
        (7, "\x00a ßİ token: abc password = 'hunter2x'", "de", "a", 1, "nul", True),
        (8, line.upper() + " a", "en", "b", 9, "near", True),
    ]
    schema = "doc_id long, text string, lang string, source string, size long, kept string, row boolean"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0).cache()
