import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and to in that with for was this from they have which there",
    "de": "der die und nicht auch mit über für schön ist eine werden groß daß weiß",
    "fr": "le la et être dans pour très où avec français élève été même près déjà",
}


def text_of(lang: str, n: int, seed: int) -> str:
    import random

    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(WORDS[lang].split()) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def odd_rows():
    """Null in every column, empty and very long texts, repeated rows, ties, odd white space."""
    long = text_of("en", 20_000, 1)
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", "a", 1), (None, "no id", "en", None, 5), (4, long, "en", "a", len(long)), (5, long, "en", "a", len(long)), (5, long, "en", "a", len(long)),
        (6, " \n\t  two  spaces \n", "fr", "b", 3), (7, "é" * 700 + "\n\n<|endoftext|> 日本 😀", None, "b", None), (8, "12345 !!! ...", "de", "c", 13), (9, "\x00\x01 control", "en", "c", 9), (5, "another text of id five", "en", "c", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names clash with the operators' own."""
    rows = [(*r, "f", 7, "p", 1.0, "d", 3) for r in odd_rows]
    return spark.createDataFrame(rows, SCHEMA + ", file string, row long, part string, score double, digest string, key int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    rows = []
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, text_of(lang, 30 + i % 50, i), lang, f"s{i % 5}", 100))
    return spark.createDataFrame(rows, SCHEMA)
