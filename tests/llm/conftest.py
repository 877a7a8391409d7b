import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers find the library wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "rep long, b int, value string, size string, n int, `odd name` string, label string"
)
EXTRA = (7, 1, "v", "s", 3, "o", "l")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white texts, one word, a very long text, repeated rows, ties."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    sentence = " ".join(words)
    rows = [
        (None, sentence, "en", "a", 1),
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n\x0b", "xx", "b", 4),
        (4, "word", "en", "b", 4),
        (5, sentence, "en", "a", 60),
        (5, sentence, "en", "a", 60),
        (6, sentence.upper(), "en", "ü", 60),
        (7, sentence + " nu", None, "", 63),
        (8, "x\x00y " * 9 + "é" * 60 + " 日本語 <|endoftext|>", "ja", "c", 9),
        (9, " ".join(words[(i * i + i // 7) % 12] + str(i % 997) for i in range(40_000)), "en", "a", 1),
        (10, "z" * 300_000, "en", "a", 1),
    ]
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
