import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lines string, kept int, doc long, score double, size string"
LINE = "This very line stands in many documents, word for word as it is."


def awkward_rows() -> list[tuple]:
    """Nulls, blanks, a very long text, ties, copies and near copies, with columns named as operators name theirs."""
    base = " ".join(f"word{i} of passage" for i in range(60))
    texts = [
        None,
        "",
        " \t\n ",
        "one",
        "One",
        "two words",
        base,
        base.upper(),
        base + " more",
        base + " " + " ".join(f"tail{i}" for i in range(300)),
        "\n".join([LINE] * 3),
        *[f"text {i}\n  {LINE}\t\nend {i}" for i in range(6)],
        "Été " + base.replace("word7 ", "wörd7 "),
        "x" * 30_000,
        ("abc " * 20_000),
        " ".join(f"long{i % 977}" for i in range(30_000)),
        "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0\n\nReleased under the MIT\n license",
        "\x00 nul \x01 and\x0bmore 'S don't 3½ <|endoftext|> ﬁ",
    ]
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["a", "b", None, ""][i % 4]) for i, t in enumerate(texts)]
    rows.append((None, base + " x", None, None))
    rows.append(rows[6])  # a repeated row
    return [(i, t, la, so, None, "x", 1, 2, 0.5, "y") for i, t, la, so in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
