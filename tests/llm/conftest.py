import random

import pytest

SYLLABLES = "an ber co di el fra gu ho ir lo mi ne or pa qui re sto tu va ze".split()


def prose(rng, words):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, odd characters, and columns whose names an operator might use."""
    rng = random.Random(4)
    base = prose(rng, 80)
    near = base.split()
    near[40] = "altered"
    rows = [
        (1, base, "en", "b", 3), (2, base, "en", "b", 3), (3, " ".join(near), "de", "a", None), (4, None, None, None, 1), (5, "", "en", "a", 2),
        (6, " \n\t ", "en", "a", 2), (7, "two words", "fr", None, 5), (8, "Two  WORDS", "fr", "b", 5), (8, "Two  WORDS", "fr", "b", 5),
        (None, base, "en", "c", 6), (None, "a line to share\nown line here", "en", "c", 6), (9, "A LINE to share \nlast", "en", "c", 7),
        (10, "a line to share\na line to share\n\n", "es", "b", 1), (11, "été \U0001F600 中文 'll 12\x0b3\x1c4 " * 3, "fr", "b", 9),
        (12, prose(rng, 60_000), "en", "b", 1), (13, "x" * 300_000, "en", "a", 1), (14, "same\n" * 500, "en", "c", 1),
    ]
    rows += [(100 + i, prose(rng, rng.randint(1, 120)), "en", rng.choice("abc"), i) for i in range(40)]
    clash = ("ids", "n", "doc", "kept", "shard", "size", "pos", "line", "part", "signatures", "score", "digest", "root", "units")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in clash)
    return spark.createDataFrame([(*r, *clash) for r in rows], schema).repartition(5)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
