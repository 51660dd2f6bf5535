import random

import pytest

pytest.importorskip("quarry.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("digest", "chunk", "row", "node", "group", "kept", "keep_id", "d2", "f0", "c0", "own", "key", "ids", "label",
            "n_words", "template", "host", "content_digest", "n_removed", "kind", "h")


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{'.' if i % 11 == 10 else ''}{chr(10) if i % 37 == 36 else ''}"
                    for i in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, ties, repeated rows, one very long text."""
    base = prose(1, 300)
    copy = base.split(" ")
    near = " ".join([*copy[:150], "changed", *copy[151:]])
    shared = prose(2, 90)
    texts = [(1, base), (2, base), (3, near), (4, prose(3, 400)), (5, ""), (6, ""), (7, "  \n\t "), (8, None),
             (None, None), (None, prose(4, 50)), (9, prose(5, 60) + "\n" + shared + "\n" + prose(6, 40)),
             (10, prose(7, 30) + "\n" + shared + " " + prose(8, 80)), (11, "same line\n" * 60),
             (12, "é ü 日本 \x00 <|endoftext|> ▁▁ a  b\r\nc"), (13, "a"), (14, "a" * 700), (15, prose(9, 40_000)),
             (4, prose(3, 400)), (4, prose(3, 400)), (4, prose(10, 70)), (16, "w1 w2 w3 " * 70)]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src", None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return docs.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: three shuffle partitions are enough to have several tasks."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
