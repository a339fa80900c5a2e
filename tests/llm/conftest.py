import random

import pytest


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeilnorstu", k=rng.randint(2, 9))) for _ in range(words))


#: Every odd row that an operator has to stand: nulls, empty and white texts, few
#: words, repeated rows, a very long text, marks beyond the first plane.
ODD = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (4, "One two.", "en", "b"),
    (5, prose(5, 300), "en", "b"), (5, prose(5, 300), "en", "b"), (6, prose(5, 300), None, "b"),
    (7, prose(7, 40_000), "fr", "c"), (None, prose(8, 120), "fr", "c"), (9, "x" * 30_000, "en", "c"),
    (10, "𝓣𝓮𝔁𝓽 🤖 <|endoftext|> Œuvre\u0000\x1c", "fr", "c"), (11, prose(5, 150) + "\n\n" + prose(11, 150), "en", "a"),
    (12, "le " * 500, "fr", "a"), (13, "Under the MIT License. 12 Apache License!", "en", "a"), (14, "idiot loser scum", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators may use themselves."""
    schema = "doc_id long, text string, lang string, source string, score double, rep long, spans string, bucket int, _block string, hash long, tree string"
    rows = [(*r, 1.0, 2, "s", 3, "b", 4, "t") for r in ODD]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (14, 0, 1), (None, 1, 1), (7, None, None), (11, 1, 0)], "doc_id long, quality int, toxic int")
