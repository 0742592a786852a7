import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, drops string, kept string, fp string, score double, rate double, component_id string, spans string, rank int, ids string"


def rows_of(pairs):
    return [(i, t, "en", "s", len(t) if t else 0, "x", "x", "x", "x", 0.0, 0.0, "x", "x", 1, "x") for i, t in pairs]


def words(rng, n):
    return " ".join("".join(rng.choice(("ba", "ko", "ri", "tu", "es", "no")) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Nulls, blanks, ties, copies, near copies, repeated rows, shared lines, and one very long text."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(5, 120)) for _ in range(40)]
    shared = "A line that several documents hold, Ä and all."
    pairs = list(enumerate(base))
    pairs += [(100 + i, base[i]) for i in range(6)] + [(110 + i, base[7]) for i in range(5)]
    pairs += [(200 + i, f"{base[20]}\n  {shared.upper() if i % 2 else shared}\t\n{base[i]}") for i in range(4)]
    long = "\n".join(words(rng, 60) for _ in range(300))
    pairs += [(300, long), (301, long.replace("ko", "kó", 1)), (302, long + " end")]
    pairs += [(400, None), (401, ""), (402, " \t\n "), (403, "\n\n"), (404, "one"), (405, "one two"), (406, "ONE two"), (407, "\x85   mixed\x0bblank"), (50, base[3]), (50, base[3]), (None, base[4]), (None, shared)]
    return pairs


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
