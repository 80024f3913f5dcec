import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ti", "vo") for b in ("ra", "st", "nd", "pe", "qua", "x.")]


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): random prose with copies, near copies, shared passages, nulls, blanks, odd bytes and a long one."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) + rng.choice(("", "", rng.choice(WORDS))) + ("\n" if rng.random() < 0.05 else "") for _ in range(n))
    base = [prose(rng.randint(1, 160)) for _ in range(30)]
    passage = prose(45)
    out = [*base, base[3], base[3], base[5], None, "", " \n\t", "one", "<|endoftext|> ä œ 漢字", passage + " end", "start " + passage, prose(4000)]
    near = base[7].split(" ")
    near[len(near) // 2] = "changed"
    out += [" ".join(near), " ".join(["first", *base[7].split(" ")])]
    return [(i * 3, t) for i, t in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts, with a repeated row, a null id and columns whose names clash with the operators' own."""
    rows = [(i, t, "x", 1, 2) for i, t in [*texts, texts[4], (None, "nobody knows whose text this is")]]
    return spark.createDataFrame(rows, "doc_id long, text string, _chunk string, _id int, start int").repartition(3).cache()


@pytest.fixture(scope="session")
def all_rows(texts):
    return [*texts, texts[4], (None, "nobody knows whose text this is")]


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
