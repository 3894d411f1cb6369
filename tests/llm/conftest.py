import pytest
from pyspark.sql import types as T


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the columns of the table."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def make(rows, lang="en", source="s"):
        return spark.createDataFrame([(i, t, lang, source, len(t) if t is not None else None) for i, t in rows], schema)

    return make


def prose(seed: int, n: int) -> str:
    """``n`` made-up words, another text for each seed."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeionrst") for _ in range(draw.randint(3, 8))) for _ in range(n))


ODD = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "x" * 70_000)]
