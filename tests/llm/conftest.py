import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = ["score", "slot", "shard", "size", "key", "epoch", "label", "words", "taken", "target", "rank", "id", "cell", "lang_pred"]


def prose(rng, n, syllables="th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a, "en", "s1", len(a)), (1, a, "en", "s1", len(a)), (2, a, "en", "s2", len(a)), (3, b, None, None, None),
            (None, a, "en", "s1", len(a)), (None, None, None, None, None), (4, "", "en", "s1", 0), (5, " \t\n ", "fr", "s2", 4),
            (6, "one", "en", "s1", 3), (7, prose(rng, 30_000), "en", "s3", None), (8, "x" * 200_000, "de", "s3", 200_000),
            (9, "12 34 !!", "fr", "s3", 8), (2 ** 60 + 1, b, "en", "s2", len(b)), (10, None, "en", "s1", None)]
    return rows + [(20 + k, prose(rng, 40), ("en", "fr")[k % 2], f"s{k % 3}", 1) for k in range(30)]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    from pyspark.sql import functions as F

    from fleetlens.llm.common import ready
    df = ready(spark).createDataFrame(messy_rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    from fleetlens.llm.common import ready
    return ready(spark).createDataFrame([], SCHEMA)
