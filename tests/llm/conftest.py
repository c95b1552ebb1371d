"""Small awkward tables that every operator has to take."""

import hashlib

import pytest
from pyspark.sql import functions as F
from samples import CLASHES, awkward_rows


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string").repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, F.lit(hashlib.md5(name.encode()).hexdigest()[:4]))
    return df


@pytest.fixture(scope="session")
def nameless(spark):
    """Rows without doc_id, source and language."""
    return spark.createDataFrame(
        [(None, "same words here", None, None), (None, "same words here", None, None), (None, None, None, None),
         (1, "same words here", None, None)], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
