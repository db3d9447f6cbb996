import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    from cauce.llm.base import importable

    importable(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids, texts and sources, empty and long texts, ties, repeated rows."""
    rng = np.random.default_rng(5)
    words = ["ala", "Bem", "cor,", "dun", "eel.", "fig", "the", "of", "Zürich", "naïve"]
    long = " ".join(rng.choice(words, 30_000))
    near = " ".join(rng.choice(words, 400))
    prose = ["\n".join(" ".join(rng.choice(words, 12)) for _ in range(9)) for _ in range(12)]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t)) for i, t in enumerate(prose)]
    rows += [
        (100, long, "en", "s0", len(long)),
        (101, None, None, None, None),
        (102, "", "en", "s1", 0),
        (103, " \t\n", "en", "s1", 3),
        (104, near, "en", "s2", None),
        (105, near + " tail", "en", "s2", None),
        (106, near.replace(" ", "  \n"), "en", "s2", None),
        (106, near, "en", "s2", None),
        (107, prose[0], "en", "s0", None),
        (107, prose[0], "en", "s0", None),
        (None, prose[1], "en", "s0", None),
        (None, "q" * 70, None, None, None),
        (None, "q" * 70, None, None, None),
        (7, "x" + prose[7][40:200] + "y", "en", "s0", None),
        (108, "mail ann.b@mail.example.org or +1 (403) 555-9312, card 4111 1111 1111 1111, ip 10.0.0.255", "en", "s0", 9),
        (109, "Licensed under CC BY 4.0.\nAll rights reserved. Released under the MIT License.", "en", "s0", 9),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    for name in ("row_uid", "uid", "kept", "ids", "queue", "norm_length", "component_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
