import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, fp long, fingerprint string, n_words string, verdict string, sequence_id string, __id long, __wm_hits binary, __text string, _row int"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, a null id; names that clash with results."""
    long_text = prose(1, 30_000)
    texts = [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "One two"), (5, "one TWO"), (6, long_text), (7, prose(2, 80)), (7, prose(2, 80)),
        (None, prose(3, 60)), (8, prose(3, 60)), (9, "42 !! ?"), (10, "x" * 200_000), (11, "spam eggs ham " * 400), (12, "Ünï cödé ☃ 日本語 " + prose(4, 40)),
    ]
    return [(i, t, None if i in (1, None) else "xx", None, None, "k", "s", 5, "f", "w", "v", "q", 9, b"x", "t", 3) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
