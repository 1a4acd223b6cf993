import random

import pytest

#: Extra columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, t1 string, fp string, length string, bucket string, anchors string, `rank` string, key string"


def frame(spark, rows):
    """rows of (doc_id, text) with the other columns of documents and some that clash."""
    full = [(i, t, None if t is None else "en", "s", None if t is None else len(t), "x", "x", "x", "x", "x", "x", "x", "x") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies and shared passages."""
    r = random.Random(5)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "Ünï", "le", "und"]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, base = say(70), say(300)
    long = say(30_000)
    rows = [
        (1, base), (2, base), (3, base + " tail"), (3, base + " tail"), (4, say(40) + " " + shared + " " + say(20)), (5, say(10) + "\n" + shared + "\t" + say(90)),
        (6, None), (7, ""), (8, "   \n"), (9, long), (10, say(100) + " " + long[5000:9000]), (11, shared + " " + shared), (12, "one"), (13, "one two three"),
        (14, "é" * 150 + " " + "ab" * 200), (15, "ab" * 300), (None, base), (None, "alone here"), (16, say(49)), (17, say(50)), (18, say(60)), (18, say(60)), (19, "###"), (20, "a  b   c \n \n d"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
