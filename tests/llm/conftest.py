import pytest
from pyspark.sql import types as T

TEXTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("n_tokens", T.StringType()), T.StructField("block", T.StringType()),
])


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (id, text) pairs, with extra columns that operators use for themselves."""

    def make(rows, lang=None):
        return spark.createDataFrame([(i, t, lang, "x", "y", "z") for i, t in rows], TEXTS)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _words(n, seed=0):
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abdeilmnorstu") for _ in range(draw.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def words():
    """Random words, the same for the same seed."""
    return _words


#: Null, empty, white space, tied and repeated rows, a null id and a very long text.
@pytest.fixture
def awkward(documents, words):
    long = words(40_000, 9)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, words(60, 1)), (7, words(60, 1)),
            (6, words(60, 1)), (None, words(30, 2)), (None, None), (8, long), (9, "x" * 5000), (10, "á \U0001F600 <|endoftext|>")]
    return rows, documents(rows)
