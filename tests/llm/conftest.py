import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, at long, part int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    rng = random.Random(5)
    vocab = [a + b for a in ("on", "ti", "re", "sha", "é") for b in ("ng", "st", "ü", "the", "x1")]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = prose(120)
    rows = [(i, prose(rng.randint(1, 200)), rng.choice(["en", "de"]), f"s{i % 3}", 1, "x", 5, 9) for i in range(60)]
    rows += [(100 + i, base, "en", "s0", 1, None, 5, 9) for i in range(12)]
    rows += [(200 + i, " ".join(["changed%d" % i, *base.split()[1:]]), "en", "s0", 1, None, 5, 9) for i in range(12)]
    rows += [(300, None, None, None, None, None, None, None), (301, "", "en", "s1", 0, "", 0, 0), (302, "   \n\t ", "en", None, 0, "", 0, 0)]
    rows += [(None, base.upper(), "en", "s0", 1, "x", 1, 1), (None, "null id", None, "s1", 1, "x", 1, 1), (None, "null id", None, "s1", 1, "x", 1, 1)]
    rows += [(400, prose(30_000), "de", "s2", 1, "x", 1, 1), (401, "one", "de", "s2", 1, "x", 1, 1), (401, "one", "de", "s2", 1, "x", 1, 1), (402, "x" * 200_000, "de", "s2", 1, "x", 1, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
