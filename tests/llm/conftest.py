import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, code string, n long, row long"


def sentence(rng, words, count):
    return " ".join(rng.choice(words) for _ in range(count))


@pytest.fixture(scope="session")
def rows():
    """Texts with copies, near copies, shared passages and lines, and the odd cases, as (id, text)."""
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("", "n", "r", "st", "é")]
    base = sentence(rng, words, 120)
    near = base.split()
    near[60] = "other"
    passage = sentence(rng, words, 50)
    line = "This very common line is longer than forty characters."
    texts = [sentence(rng, words, rng.randint(1, 200)) for _ in range(40)]
    texts += [base, base, base.upper(), " ".join(near), "\t".join(near[:-1])]
    texts += [f"{sentence(rng, words, 30)} {passage} {sentence(rng, words, 30)}" for _ in range(3)]
    texts += [f"{sentence(rng, words, 8)}\n {line} \n{sentence(rng, words, 8)}\n" for _ in range(6)]
    texts += ["", None, "   \n\t ", "one", "One", "a b c d", "x " * 90, "é" * 5000, "w" * 9000, "\n" * 50]
    texts += [sentence(rng, words, 30_000)]
    out = [(k, t) for k, t in enumerate(texts)]
    out += [(3, texts[3]), (3, texts[3]), (4, "another text with the id of one before"), (None, base), (None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "c", 2, 3) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
