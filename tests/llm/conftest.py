import random

import pytest

VOCABULARY = "the of and to in was for with that this on are by".split() + [a + b for a in "ka lo mi nu re sa".split() for b in "ba do fe gi".split()]


def prose(seed: int, n: int) -> str:
    """Words in lines, the same for the same seed."""
    choose = random.Random(seed)
    words = [choose.choice(VOCABULARY) + (choose.choice([",", "."]) if choose.random() < 0.1 else "") for _ in range(n)]
    return "\n".join(" ".join(words[k : k + 12]) for k in range(0, n, 12))


#: Nulls in all columns, empty, blank and very long texts, ties and repeated rows.
ODD_ROWS = [
    (1, prose(1, 300)), (2, prose(1, 300)), (3, prose(3, 120)), (3, prose(3, 120)), (4, ""), (5, None), (None, prose(6, 80)), (None, None),
    (7, " \n\t "), (8, "one two"), (9, prose(9, 20_000)), (10, "x" * 70_000), (11, prose(3, 120) + " tail"), (12, "日本 é́ 　 a\x00b <|endoftext|> \x1c \x85"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns named like columns the operators make."""
    clashing = "n_words value node region place salt length number digest keys kept once starts score x image shard words row __w sequence_id offset".split()
    rows = [(a, b, *(["clash"] * len(clashing))) for a, b in ODD_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in clashing)).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("1 = 0")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
