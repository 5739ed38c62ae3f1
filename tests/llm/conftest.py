import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          # names that the operators use themselves
          "id string, size string, part string, row string, key string, copy string, node string, doc string, spans string, "
          "place string, known string, again string, none string, tie string, root string, times string")
EXTRA = ("x",) * 16


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["the", "an", "re", "ti", "on", "es", "th", "er", "in", "ou"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def document_rows():
    """Nulls, empty and very long texts, ties, repeated rows; one source with most rows."""
    rows = [(i, prose(i, 30 + i % 40), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(60)]
    rows += [(100, None, "en", "hot"), (101, "", None, None), (102, " \n\t ", "fr", "hot"), (103, "123 456 !!!", "en", "s1")]
    rows += [(104, prose(7, 60_000), "en", None), (105, "a", "en", "s2"), (None, "token = abcdef0123", "en", "hot")]
    rows += [(None, None, None, None), (106, rows[1][1], "en", "hot"), rows[2], rows[2]]
    rows += [(107, "日本語 テスト 🤦🏼‍♂️ password: hunter22", None, "s1"), (108, "\x00\x01 x" * 50, "en", "s1")]
    return [(*r, len(r[1] or "")) + EXTRA for r in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain():
    """``doc_id, text, source`` of the rows."""
    return [(r[0], r[1], r[3]) for r in document_rows()]
