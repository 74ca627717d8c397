import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
                                      ("source", T.StringType()), ("n_chars", T.LongType()))]
)


def _prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows, odd white space."""
    base = _prose(1, 300)
    near = base.split()
    near[150] = "changed"
    texts = [
        (0, None), (1, ""), (2, " \t\n"), (3, base), (4, base), (5, " ".join(near)), (5, " ".join(near)),
        (6, "short one"), (7, "short one"), (8, _prose(2, 60) + "\n" + _prose(3, 55)),
        (9, _prose(4, 30) + " " + _prose(3, 55) + " " + _prose(5, 30)), (None, base), (None, None),
        (10, "é日🎉  x y\x1cz 's 've it's\r\n\r\n  end "), (11, "x" * 9000 + " " + "- " * 200),
        (12, " ".join(["again and again"] * 40)), (13, _prose(6, 20_000)),
    ]
    return [(i, t, "en" if k % 3 else None, None if k % 4 == 0 else f"s{k % 2}", None) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
