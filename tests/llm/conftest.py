import pytest
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta omega river stone cloud north paper glass light".split()

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names the operators use inside
    *(T.StructField(c, T.StringType()) for c in ("size", "row", "node", "x", "kept", "digest", "maybe", "bits", "block", "h", "skey", "piece", "score", "label")),
])


def prose(seed: int, n: int) -> str:
    out, state = [], seed * 2654435761 + 12345
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(state >> 33) % len(WORDS)] + WORDS[(state >> 45) % len(WORDS)])
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base, "en", "b"), (2, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", None), (4, base.replace(" ", "  "), "de", "a"),
        (5, None, "en", "a"), (6, "", None, "b"), (7, " \t\n", "fr", None), (None, prose(2, 50), "en", "c"), (None, None, None, None),
        (8, "one two", "en", "a"), (9, "one two", None, "b"), (10, prose(3, 30000), "de", "c"), (11, "x" * 300000, "en", "c"),
        (12, "same line here now again\n" * 40, "en", "a"), (13, "0123 !!! ---", "en", "b"), (14, "Überraschung façade 你好 \U0001F600 ß", "de", "b"),
    ]
    texts += [(100 + i, prose(10 + i, 60 + i), ("en", "de", "fr", "es")[i % 4], f"s{i % 3}") for i in range(40)]
    return [(i, t, la, s, None if t is None else len(t), *(["q"] * 14)) for i, t, la, s in texts]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(100, 140)] + [(1, None, None), (None, 1, 1), (101, 0, 1), (101, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
