import pytest
from pyspark.sql import types as T

from tests.conftest import *  # noqa: F403


def make_docs(spark, rows, parts=3):
    """A documents table with columns whose names the operators use inside."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("keep_id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("length", T.StringType()),
        T.StructField("class_id", T.StringType()), T.StructField("h", T.StringType()), T.StructField("spans", T.StringType())])
    data = [(i, t, None if k % 3 else "en", f"s{k % 4}", None if t is None else len(t), "x", "y", None, "z", "c", "h", None) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, schema)
    return df.repartition(parts) if parts else df


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

EDGE = [
    (1, None), (2, ""), (3, " "), (4, "Alpha BETA"), (5, "alpha beta"), (6, "ÄLPHA beta"), (7, "älpha beta"), (5, "alpha beta"),
    (None, "alpha beta"), (None, None), (8, "one\ntwo\tthree  four"), (9, "x" * 30_000), (10, "ab " * 20_000), (11, "X" * 30_000),
    (12, "<|endoftext|> mixed <|endoftext|>"), (13, "  tail\u0085 \x00\x1f"), (14, "é \U0001f600 中文"), (15, "0"),
    (-3, "negative id"), (2 ** 40, "large id"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):  # noqa: F811
    return make_docs(spark, EDGE)


@pytest.fixture(scope="session")
def no_docs(spark):  # noqa: F811
    return make_docs(spark, [(1, "x")]).where("doc_id = 99")
