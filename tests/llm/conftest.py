import random

import pytest

from dwelltime.llm.tables import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, stats string, hash long"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def corpus(llm):
    """Documents from (id, text) pairs, with columns whose names the operators use themselves."""
    def make(rows):
        return llm.createDataFrame(
            [(i, t, "en", "src", len(t or ""), "mine", 1) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded sentences of invented words."""
    def make(seed, n, width=400):
        rng = random.Random(seed)
        return " ".join(f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.randrange(width)}" for _ in range(n))

    return make


#: Texts every operator must take: nulls, blanks, one word, odd characters, a long run.
ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "word"), (904, "é 中 \U0001F600\x00 ▁x"), (905, "y" * 5000),
       (None, "no id at all"), (907, "twin " * 60), (907, "twin " * 60)]


@pytest.fixture(scope="session")
def odd():
    return ODD
