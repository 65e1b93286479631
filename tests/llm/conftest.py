import random

import pytest

CLASHING = "words string, kept string, size string, row_ string, place string, fp string, n_words string, fingerprint string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "Theon", "inther", "shing,", "re.", "atonred", "blethe", "onder"]) + rng.choice(["", "", "a", "er"]) for _ in range(n))


@pytest.fixture(scope="session")
def make(spark):
    """Documents with clashing extra columns from (doc_id, text, lang, source)."""

    def frame(rows):
        full = [(i, t, lang, source, None if t is None else len(t), *["x"] * 8) for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return frame


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty and blank texts, null ids, languages and sources, repeated rows and ids, a very long text."""
    rng = random.Random(5)
    rows = [(i, "\n".join(sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 9))), rng.choice(["en", "de"]), rng.choice("abc")) for i in range(60)]
    rows += [rows[3], rows[3], (4, rows[4][1] + " more", "en", "a"), (61, rows[7][1], "en", "b")]
    rows += [(100, None, "en", "a"), (101, "", "en", "b"), (102, " \n\t ", None, "a"), (None, "no id here at all", "en", None), (None, "no id here at all", "en", None)]
    rows += [(103, sentence(rng, 60_000), "en", "c"), (104, "same line here is eight words long ok\n" * 9, "de", "b"), (105, "Ünï cödé あ \U0001f600 text", None, "b")]
    return rows


@pytest.fixture(scope="session")
def edge(make, edge_rows):
    return make(edge_rows)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
