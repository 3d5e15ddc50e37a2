"""Registered queries over delivered weekly rows and over a filled state and log, against their SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from kpiweave.plans import catalog, oracle

SF_DIR = os.environ.get("KPIWEAVE_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["matrix_weekly_delivered", *sorted(n for n in catalog.QUERIES if n.startswith("fold_stored_"))]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert difference(catalog.queries()[name](spark, SF_DIR), connect(SF_DIR), oracle.oracle_sql()[name]) is None


def test_delivered_rows_meet_the_matrix(spark):
    found = catalog.queries()["matrix_weekly_delivered"](spark, SF_DIR).where("IsDelivered = '1'")
    assert found.where("Input_File LIKE 'weekly_%.csv' AND Remarks IS NOT NULL").count() > 0


@pytest.mark.parametrize("name", ["daily", "weekly"])
def test_stored_fold_starts_from_a_filled_state_and_log(spark, name):
    done = catalog.Feeds(spark, SF_DIR).fold_stored(name)
    log = done.corrections.select("FileOld", "FileNew").distinct().collect()
    assert (f"{name}_1.csv", f"{name}_2.csv") in log and any(r["FileOld"] == f"{name}_2.csv" for r in log)
    assert done.output.where(F.col("Input_File") == f"{name}_1.csv").count() > 0
    assert done.corrections.count() > done.new_corrections.count() > 0
