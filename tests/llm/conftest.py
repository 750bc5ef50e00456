import pytest
from pyspark.sql import types as T

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("n_lines", T.StringType()),
    T.StructField("kept", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("n_tokens", T.StringType()),
    T.StructField("component_id", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("word", T.StringType()),
])
LONG = " ".join(f"word{i % 977} of text{i % 13}" for i in range(20_000))
#: NULLs, blanks, copies, repeated rows, one id with two texts, one very long text.
TEXTS = [
    (1, "The cat sat on the mat\nand\n  AND  \n", "en"),
    (2, "the cat sat on the mat\nAnd\n\n", "en"),
    (3, None, None),
    (4, "", "fr"),
    (5, " \t\n\x0b ", "de"),
    (6, "a\tb\x0bc", None),
    (7, "Überall wächst der Baum. ▁ 日本語 🎉 a\x00b\r\n", "de"),
    (7, "Überall wächst der Baum. ▁ 日本語 🎉 a\x00b\r\n", "de"),
    (8, "x " * 200, "en"),
    (9, LONG, "en"),
    (10, LONG + " end", "en"),
    (None, "no id\nand", "en"),
    (11, "9", None),
    (12, "12 34 !?", "es"),
    (13, "le chat est sur la table et la souris est dans la maison\nand", "fr"),
    (14, "<0x0A></s><unk> <|im_end|> \\ \\\\n", "en"),
    *[(20 + i, f"line {i}\nShared Line\n{i % 2}", "en") for i in range(12)],
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with every oddity, and columns named as operators name theirs."""
    rows = [(d, t, lang, "a", "b", "c", "d", "e", "f", "g") for d, t, lang in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def middle(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")
