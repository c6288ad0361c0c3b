import random

import pytest
from made_texts import edited, prose


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source): copies, near copies, common lines, leaks, odd texts; ids are unlike."""
    rng = random.Random(3)
    texts = [prose(i, rng.randint(60, 200)) for i in range(40)]
    texts += [texts[0]] * 4 + [edited(texts[1], i, 0.01) for i in range(8)] + [edited(texts[2], i, 0.04) for i in range(6)]
    shared = "This Very common LINE stands in many texts"
    texts += [f"{prose(100 + i, 30)}\n {shared.upper() if i % 2 else shared}\t\n{prose(200 + i, 30)}" for i in range(7)]
    texts += [f"{prose(300 + i, 40)} {item} {prose(400 + i, 40)}" for i, (_, item) in enumerate(ITEMS)]
    texts += ["*** ".join(prose(500 + i, 80).split(" ")) for i in range(5)]
    texts += ["again and again " * 40, prose(600, 9000), "word", "one two", "ONE two", "", None, "   \n\t ", "\n", "ça été <|endoftext|> it's  ２ x"]
    return [(i, t, "xx" if i % 3 else "yy", f"s{i % 4}" if i % 7 else None) for i, t in enumerate(texts)]


ITEMS = [(i, prose(1000 + i, n)) for i, n in enumerate((15, 20, 33, 57, 40))] + [(7, "three word item")]


@pytest.fixture(scope="session")
def items():
    return ITEMS


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in corpus], DOC)


@pytest.fixture(scope="session")
def odd(spark, corpus):
    """Null ids, rows that share an id, repeated rows, nulls in every column, and columns named like results or helpers."""
    rows = [(*r, 1) for r in corpus[:3]] + [(*corpus[0], 1)] * 2
    rows += [(5, corpus[6][1], None, None, None), (None, corpus[7][1], None, None, None), (None, corpus[7][1], "xx", "s1", 2)]
    rows += [(None, None, None, None, None), (None, corpus[8][1], "yy", None, 3), (6, corpus[7][1], "xx", "s1", 2)]
    extra = "n_words long, kept string, size string, score string, token string, row string, count string, n_lines string"
    return spark.createDataFrame([(*r, 9, *"abcdefg") for r in rows], f"{DOC}, {extra}")
