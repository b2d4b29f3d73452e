import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that the operators use inside or return
                     *[T.StructField(n, T.StringType()) for n in ("id", "score", "ids", "spans", "base", "root", "key", "unit", "value")]])


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "sigma", "tau", "phi"]) + str(rng.randrange(900)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) with NULL, empty and very long texts, copies, near copies, repeated rows and shared passages."""
    rng = random.Random(7)
    passage = sentence(rng, 90)
    first = sentence(rng, 120)
    near = first.split()
    near[60] = "changed"
    out = [(0, None), (1, ""), (2, "   \n\n "), (3, "one"), (4, first), (5, first), (6, " ".join(near)), (7, sentence(rng, 50)),
           (8, sentence(rng, 40) + " " + passage + " " + sentence(rng, 30)), (9, sentence(rng, 25) + "\n" + passage + "\n" + sentence(rng, 70)),
           (10, "é" * 3000 + "ab" * 2500), (11, sentence(rng, 4000)), (12, sentence(rng, 30)), (12, None)]
    out.append(out[7])  # a repeated row
    out += [(20 + i, sentence(rng, 20 + i)) for i in range(10)]
    out += [(40 + i, " ".join([*near[:i * 3], f"edit{i}", *near[i * 3:]])) for i in range(12)]  # a group of near copies
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["x"] * 9) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, texts).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
