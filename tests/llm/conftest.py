import random

import pytest

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names the operators use inside
    "n long, size long, row string, kept boolean, component string, place int, part int, removed string, _row int"
)


def random_words(n, seed, vocabulary=3000):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = "\n".join(" ".join(random_words(500, s)) for s in range(60))
    plain = " ".join(random_words(60, 100)) + ".\nsecond line here #1 & more"
    near = plain.replace("second", "other")
    texts = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t\x0b ", "en", "a", 5),
        (4, long_text, "de", "b", len(long_text)),
        (5, long_text.replace(" ", "  "), "de", "b", 1),
        (6, plain, "en", "a", len(plain)),
        (6, plain, "en", "a", len(plain)),
        (7, near, "en", None, len(near)),
        (8, "one", None, "c", 3),
        (9, "ONE", None, "c", 3),
        (None, plain, "en", "a", None),
        (10, " ".join(random_words(40, 7) * 3), "fr", "a", 2),
        (11, "x" * 50_000, "fr", "é", 2),
        (12, "naïve “text” 漢字 \U0001f600 <|endoftext|> a  b\n\n c ", "fr", "b", 2),
        (6, near, "en", "b", 4),
    ]
    return [(*t, 1, None, "r", None, "x", 3, 0, "-", 5) for t in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3, "text")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def few(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
