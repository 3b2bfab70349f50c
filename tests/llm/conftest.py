import random

import pytest

LONG = 40_000


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus():
    """(doc_id, text) rows with nulls, empty and long texts, repeated rows, copies and near copies."""
    rng = random.Random(4)
    base = sentence(rng, 140)
    passage = sentence(rng, 60)
    rows = [(1, base), (1, base), (2, None), (3, ""), (4, "  \n\t "), (5, "two words"), (6, "Two  WORDS"), (7, base.upper())]
    for i in range(8, 30):  # near copies, more and more edited
        words = base.split()
        for at in rng.sample(range(len(words)), (i - 7) % 9):
            words[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(words)))
    for i in range(30, 40):
        rows.append((i, sentence(rng, 20) + " " + passage + "\n" + sentence(rng, rng.randint(5, 40))))
    rows += [(40, sentence(rng, LONG)), (41, "x" * 20_000), (42, "9" * 20_000), (43, ("ab cd " * 3000).strip())]
    rows += [(44, "é ünï 日本語 \x1c\x85 ok 👍 " * 12), (45, "same line here\n" * 20), (46, "### *** $$$ %%% a b c d e f g")]
    rows += [(47, "mail me at a.b+c@d-e.org or 1.2.3.4 and 4111 1111 1111 1111, +1 (499) 555-6503; 999.1.1.1")]
    rows += [(None, "a row without an id " + sentence(rng, 15)), (None, None), (-5, sentence(rng, 55))]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def texts(rows):
    """doc_id -> text of the rows with an id."""
    return {i: t for i, t in rows if i is not None}


def frame(spark, rows):
    """The rows as a table of documents, with more columns whose names the operators use inside."""
    clashing = ["words", "key_id", "key_text", "h", "row", "kind", "block", "component", "start", "length", "value", "text_"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clashing)
    langs = ["en", "de", None, "fr"]
    full = [
        (i, t, langs[k % 4], None if k % 7 == 0 else f"src{k % 5}", None if t is None else len(t), *["z"] * len(clashing))
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).persist()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
