import random

import pytest

WORDS = "the of and to in is it that was for on are with as his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


@pytest.fixture(scope="session")
def prose():
    """prose(n, seed): n words of made-up text."""
    return lambda n, seed: " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="session")
def corpus(prose):
    """(id, text): originals, exact and near copies, shared passages, short, odd, empty and null texts."""
    r, out = random.Random(1), []
    for i in range(30):
        out.append((i, prose(r.randrange(3, 90), i)))
    out += [(100 + i, out[i][1]) for i in range(0, 30, 3)]
    for i in range(40):
        w = out[r.randrange(30)][1].split()
        for _ in range(r.randrange(1, 3)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        out.append((200 + i, " ".join(w)))
    passage = prose(60, 777)
    out += [(300 + i, f"{prose(20, 900 + i)} {passage}\n{prose(15, 950 + i)}") for i in range(12)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "A b  C"), (404, "a B\nc"), (405, "é" * 150), (406, "é" * 150 + "x"), (407, "ab " * 400), (408, prose(4000, 5)), (409, "\U0001F600 日本 ▁ a"), (410, "| | |")]
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns beside it, some null."""
    rows = [(i, t, ["en", "de", None][i % 3], None if i % 5 == 0 else f"src{i % 2}", None) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
