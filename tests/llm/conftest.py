import pytest

# Columns that operators use names like these for; extra columns must not get in their way.
DECOYS = ("id", "key", "text_sha256", "name", "level", "score", "spans", "base", "node", "label", "sketches", "y", "ids", "tier",
          "digest", "first", "place", "bits", "section", "held_out", "predicted", "__other")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) pairs; ``decoys`` adds columns whose names may clash."""

    def make(pairs, decoys=False):
        df = spark.createDataFrame(list(pairs), "doc_id long, text string")
        return df.selectExpr("*", *[f"'decoy' as `{c}`" for c in DECOYS]) if decoys else df

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  two  blanks \n\n and lines\r\n"),
    (5, "same text as another one here"),
    (6, "same text as another one here"),
    (6, "same text as another one here"),
    (None, "no id at all, 1.2.3.4 and x@y.org"),
    (7, "é" * 5000 + " ß 😀 " + "word " * 3000),
    (8, "x" * 3000),
    (9, "<|endoftext|> it's we'll 123 456"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
