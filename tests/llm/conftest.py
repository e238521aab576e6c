import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """A hundred texts with copies, near copies, shared passages, odd blanks, and empty and null texts."""
    rnd = random.Random(7)
    pool = [f"w{i}" for i in range(60)] + ["Über", "été,", "THE", "the", "a-b", "x!!", "𝔸b"]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.choice([1, 3, 8, 40, 120]))) for _ in range(70)]
    passage = " ".join(rnd.choice(pool) for _ in range(50))
    texts += [f"{texts[i]}\n {passage}\t{texts[i + 1]}" for i in range(8)] + texts[:6] * 2
    for t in texts[60:66]:
        words = t.split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    return [*enumerate(texts), (900, None), (901, ""), (902, " \n\t "), (903, "the " * 3000), (None, "no id here"), (0, texts[0])]


@pytest.fixture
def table(spark):
    """Documents with a column whose name clashes with outputs and with internal names."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")

    return make
