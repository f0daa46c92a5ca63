import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "node string, bucket int, found string, __measures string, kept string, __node string, id int, row int")


def prose(seed, words, vocabulary=900):
    pick = random.Random(seed)
    names = ["".join(pick.choice("abdefghilmnoprstuv") for _ in range(pick.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(pick.choice(names) for _ in range(words))


def rows_of(*texts):
    """Document rows with extra columns whose names clash with those used inside."""
    return [(number, text, "en", "s", len(text or ""), "n", 1, "f", "m", "k", "o", 7, 8) for number, text in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty, blank, very long and repeated texts, ids that repeat or are null."""
    base = prose(1, 120)
    texts = [None, "", " \t\n ", base, base, "short text", prose(2, 30_000), "x" * 50_000, base + " end", "é😀   ß"]
    rows = rows_of(*texts)
    rows += [rows[3], (None, base, *[None] * 11), rows[0],
             (3, prose(3, 60), None, "s", 1, "n", 1, "f", "m", "k", "o", 7, 8),
             tuple([None] * 13)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").cache()
