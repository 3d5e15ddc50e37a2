"""Vectors wider than a code."""

import pytest
from pyspark.sql import functions as F

from kpiweave.llm import hamming


def test_a_wider_vector_is_an_error(spark):
    coded = lambda n: spark.createDataFrame([(1, [1.0] * n), (2, None)], "id long, v array<float>").select(hamming.sign_code(F.col("v"))).collect()
    assert [r[0] for r in coded(hamming.BITS)] == [-1, None]
    with pytest.raises(Exception, match="64 bits, a vector 65 components"):
        coded(hamming.BITS + 1)
