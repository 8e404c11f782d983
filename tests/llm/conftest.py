import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score double, SIZE string, digest string"


def odd_rows(words: str = "alpha beta gamma delta epsilon zeta"):
    """NULLs in every column, empty and long texts, repeated rows and keys, and columns that clash with made ones."""
    long_text = " ".join(f"{words} number{i}" for i in range(3000))
    return [
        (1, words, "en", "a", 10, 0.1, "x", "d"),
        (1, words, "en", "a", 10, 0.1, "x", "d"),
        (2, words, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 0.2, "y", "d"),
        (4, None, "de", "b", None, 0.3, "z", None),
        (None, "some other text without a key", "de", None, 5, 0.4, "z", "e"),
        (None, None, None, None, None, None, None, None),
        (5, long_text, "en", "b", len(long_text), 0.5, "w", "f"),
        (6, " \t\n...!", "fr", "c", 7, 0.6, "v", "g"),
        (6, "the same key and another text", "fr", "c", 7, 0.6, "v", "g"),
        (7, "你好 \U0001f600 café ſecret", "fr", "c", 7, 0.6, "v", "g"),
    ]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
