import re

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: names that the operators use inside
CLASHING = ["words", "h", "t", "measures", "fp", "print", "cuts", "lost", "component", "kept", "_salt", "block", "score", "id"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def hard_words(length=1024):
    """Two words of two letters whose polynomial hashes modulo 2^64 are equal."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(length))
    return a, a.translate({97: 98, 98: 97})


def sentence(rng, n, pool=400):
    return " ".join(f"w{rng.integers(pool)}" for _ in range(n))


@pytest.fixture()
def make_docs(spark):
    def make(texts, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or "")) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture()
def clashing():
    """The table with further columns named like the operators' own."""
    from pyspark.sql import functions as F

    return lambda df: df.withColumns({c: F.lit(7) for c in CLASHING})
