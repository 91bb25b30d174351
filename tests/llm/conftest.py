import pytest
from pyspark.sql import functions as F

from tests.conftest import SF

# every name that an operator uses inside
CLASHING = ("chunk", "doc", "c0", "key", "bucket", "n", "label", "answer", "ids", "parts", "batch", "node", "shard", "rank", "host", "tag",
            "digest", "fail_mask", "n_words", "word", "row", "decoded", "score", "weight", "limit", "block", "piece", "length", "start", "nth",
            "conv", "copies", "pos", "said", "read", "fault", "initial", "phrase", "candidate")


@pytest.fixture(scope="session")
def clash():
    """A frame with extra columns of awkward names."""
    return lambda df: df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) rows."""
    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(list(rows), schema)
    return build


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def texts(table):
    """(doc_id, text) of the small documents."""
    return [(r.doc_id, r.text) for r in table("documents").select("doc_id", "text").collect()]


LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One  two"), (6, "one two three four five"), (7, " ▁ é\U0001F600 \r\n z"),
       (8, LONG), (9, LONG + " tail"), (10, "x" * 50_000), (None, "no id here at all " * 8), (None, None), (11, "a b c d e f g h i j " * 12)]


@pytest.fixture(scope="session")
def odd():
    return ODD
