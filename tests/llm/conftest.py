import random

import pytest

WORDS = "the of and to in is that it was for on are as with his they at be this from alpha beta".split()
#: Extra columns, named like what operators add or use inside.
EXTRA = ("source string, lang string, n_chars bigint, block int, i bigint, score string, size string, "
         "node string, n_lines string, pos int, line string, _kept string")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def nasty_rows():
    """Nulls in any column, empty and long texts, equal ids, repeated rows, shared passages."""
    rng = random.Random(11)
    passage = sentence(rng, 40)
    texts = [None, "", " \t\n ", "one", "one", passage, passage, sentence(rng, 6000)]
    for k in range(40):
        cut = rng.randrange(0, 25)
        part = " ".join(passage.split()[cut:cut + rng.randrange(5, 30)])
        texts.append("\n".join([sentence(rng, rng.randrange(0, 30)), part, sentence(rng, rng.randrange(0, 9))]))
    near = passage.split() * 3
    for k in range(12):
        some = list(near)
        some[rng.randrange(len(some))] = f"x{k}"
        texts.append(" ".join(some))
    texts += ["é 日本語 😀 " + passage, " no break", "x" * 30000, "a\r\nb\n\nc"]
    rows = [(3 * k - 9, t, None if k % 7 == 0 else f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, passage, "s1"), (None, None, None), (None, sentence(rng, 30), "s2")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return nasty_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, s, None, len(t or ""), 7, 7, "own", "own", "own", "own", 7, "own", "own") for i, t, s in rows]
    return spark.createDataFrame(full, "doc_id bigint, text string, " + EXTRA)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
