"""Small texts with copies, edits, hot passages and odd rows, shared by the operator tests."""

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti", "ve") for b in ("n", "r", "st", "la", "mo", "pe", "xi", "dor")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, first int, n int, score string, rule string, label int"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edit(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def texts():
    """(id, text): originals, exact and near copies, a passage in a third of all, repeats, nulls, empty and very long texts."""
    rng = random.Random(5)
    passage = sentence(rng, 60)
    out = []
    for k in range(60):
        t = sentence(rng, rng.randint(1, 120))
        if k % 3 == 0:
            t = sentence(rng, rng.randint(0, 20)) + " " + passage + "\t\n " + sentence(rng, rng.randint(0, 20))
        out.append((k, t))
    base = sentence(rng, 150)
    out += [(100 + k, base if k < 6 else edit(rng, base, 0.01 * (k % 5))) for k in range(30)]
    out += [(200, None), (201, ""), (202, "   \t\n"), (203, "kan"), (204, "Kan LOR"), (205, "a " * 400), (206, "x" * 5000), (207, "ab" * 700),
            (208, sentence(rng, 20_000)), (209, "  ñandú  größer ЖУК 漢字 👍🏽    é́ \r\n\x0b"), (210, "kan lor mist " * 60), (None, "no id " + passage), (None, None)]
    out += [out[3], out[3], (211, passage + " " + passage)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "d", 1, 2, "x", "r", 0) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
