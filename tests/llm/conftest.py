import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, pack int"


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


_r = random.Random(3)
WORDS = ["".join(_r.choice("abcdefghijklmnop") for _ in range(_r.randrange(2, 9))) for _ in range(900)]
PASSAGE = prose(random.Random(4), 70)


def documents():
    """Texts with copies, shared passages, a hot passage, junk, nulls and clashing columns."""
    r = random.Random(5)
    texts = [None, "", "  \n\t", "one", "two words", "é ü " * 40]
    texts += [prose(r, r.randrange(60, 200)) for _ in range(40)]
    texts += [texts[10]] * 6 + [texts[11] + " tail", "Head " + texts[11]]
    texts += [prose(r, 30) + " " + PASSAGE + "\n" + prose(r, 30) for _ in range(25)]
    texts += ["same again " * 60, "12 " * 90, "x" * 30_000, prose(r, 9000)]
    lines = [prose(r, 12) for _ in range(8)]
    texts += ["\n".join(lines), "\n".join(["new line here"] + lines), "\n".join(lines[:3] + lines[:3])]
    rows = [(i, t, "en", "s", 1, "r", "s", 7) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, texts[30], None, None, None, None, None, None), (None, None) + (None,) * 6]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
