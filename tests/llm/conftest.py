import pytest
from samples import prose

EDGES = [
    (None, "a text without an id that is long enough to be more than four words"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "é ß 日本語 ΑΣ \U0001f600 'll <|endoftext|> İ"),
    (6, "same text twice in this table of documents here"),
    (6, "same text twice in this table of documents here"),
    (7, "same text twice in this table of documents here"),
    (8, "an id with two texts one"),
    (8, "an id with two texts two"),
    (9, "x" * 30_000),
    (10, "of " * 20_000),
]


@pytest.fixture(scope="session")
def edge_rows():
    """Rows that operators must take: nulls, empty and very long texts, ties, repeated rows and ids."""
    return [*EDGES, (11, prose(1, 30_000))]


# Names that operators use inside, as columns of the input.
CLASHING = "n score root rep block hub digest point base spans loose words label fold component_id held_out __pii_text __pii_base __pii_loose".split()


@pytest.fixture(scope="session")
def with_clashes(spark):
    from pyspark.sql import functions as F

    def make(rows, schema="doc_id bigint, text string"):
        df = spark.createDataFrame(rows, schema)
        return df.withColumns({name: F.lit(None).cast("string") for name in CLASHING})

    return make
