"""Tables that every operator of the package has to cope with."""

import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = " ".join(f"w{i % 977} Thing{i % 13}." for i in range(30_000))
ROWS = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, "word"), (5, "Same text here, twice over and over again now."),
    (5, "Same text here, twice over and over again now."), (6, "Same text here, twice over and over again now."),
    (None, "a row without an id, mail a.b@c.de token = 'abcdefgh12345678'"), (7, LONG), (8, "é ü ß 漢字 \U0001F600 x@y.zz"), (9, "\n\n\n"),
]
#: Names that operators use inside or for their results.
CLASHES = ("score", "rules", "pii", "secrets", "overlap", "quality_score", "label", "id", "component", "node", "__text", "training")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    kinds = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*row, *CLASHES) for row in ROWS], f"doc_id bigint, text string, {kinds}").repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
