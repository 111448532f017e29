import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for columns of their own.
        T.StructField("size", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)


def texts():
    """Texts with every hard case: NULL, empty, blank, very long, copies, near copies, marks beyond ASCII."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()
    draw = random.Random(5)
    some = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 80))) for _ in range(40)]
    some += [None, "", " \n\t ", "one", "One", "Zwei Wörter", "é😀 x y z ΑΣ <|endoftext|> Don't!"]
    some += [some[3]] * 5 + [some[3] + "."] * 3 + [some[4].replace("alpha", "omega", 1)]
    some += ["\n".join(" ".join(draw.choice(words) for _ in range(9)) + "." for _ in range(900)), "x" * 30_000, "1 " * 5000]
    return some


@pytest.fixture(scope="session")
def hard(spark):
    """Hard documents: repeated rows, NULL ids and sources, a source of a third of the rows, clashing columns."""
    rows = [
        (i, t, "en", None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 4}", len(t or ""), "s", "t", "l", "i", "k")
        for i, t in enumerate(texts())
    ]
    rows += [rows[5], rows[5], (None, "no id at all", None, None, None, "s", "t", "l", "i", "k"), (None, None, None, None, None, "s", "t", "l", "i", "k")]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
