import random

import pytest
from pyspark.sql import Row

LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(30_000))


def texts() -> dict[int, str | None]:
    """Odd and plain texts: null, empty, blank, marks only, non-ASCII, very long, copies, near copies, shared passages."""
    rng = random.Random(5)
    pool = ["the", "of", "and", "to", "in", "Straße", "ñandú", "élève", "river", "stone", "cloud", "engine", "copper", "window", "garden", "Planet", "motor", "silver"]
    make = lambda n: " ".join(rng.choice(pool) + rng.choice(["", "", "s", "ing"]) for _ in range(n))
    passage = make(60)
    base = make(120)
    out: dict[int, str | None] = {0: None, 1: "", 2: " \n\t ", 3: "### *** !!", 4: "one", 5: "two words", 6: LONG, 7: base, 8: base, 9: base}
    for i in range(10, 22):
        words = base.split()
        for _ in range(i - 9):
            words[rng.randrange(len(words))] = rng.choice(pool)
        out[i] = " ".join(words)
    for i in range(22, 30):
        out[i] = make(40) + "\n" + passage + "\n" + make(30)
    for i in range(30, 50):
        out[i] = make(rng.randrange(5, 200)) + ("\nsame line here\nsame line here" if i % 3 == 0 else "")
    out[50] = "x" * 700
    out[51] = "日本語 テキスト です。 " * 30
    out[52] = "a\x00b \x1c c d e  f\r\n g<|endoftext|>h"
    out[53] = "same " * 400
    return out


def frame(spark, rows: dict | list, **more):
    """documents with columns that clash with the operators' own."""
    items = rows.items() if isinstance(rows, dict) else rows
    out = [Row(doc_id=i, text=t, lang=more.get("lang", {}).get(i), source=None, n_chars=None, score=1.5, key="k", pos=3, band="b", word="w") for i, t in items]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, score double, key string, pos int, band string, word string").repartition(3)


@pytest.fixture(scope="session")
def corpus():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, {})
