import pytest
from llm_tables import DOCS, ROWS


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with extra columns named like columns inside the operators."""
    out = awkward
    for name in ("score", "kept", "rid", "id", "n", "label", "component", "numbers", "length", "g", "kind",
                 "bucket", "_text", "_k0", "probability", "license", "held_out", "sampled", "key"):
        from pyspark.sql import functions as F
        out = out.withColumn(name, F.lit("x"))
    return out


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
