import os

import pytest
from compare import difference

import __spark_entry__ as entry_points
from alertflow.plans import settings
from alertflow.plans.catalog import QUERIES
from alertflow.plans.oracle import SQL
from alertflow.schemas import ALERT
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ALERT.names
    assert not df.isEmpty()


def test_known_counts(spark):
    """529 of 1,000 documents are alerts, 120 of them without a type."""
    df = QUERIES["alerts"](spark, "/root/testdata/sf0.01")
    assert df.count() == 529
    assert df.filter(df.disaster == "None").count() == 120
    first = {r.id: (r.confidence, r.disaster, r.location) for r in df.filter(df.id.isin("0", "2")).collect()}
    assert first == {"0": (0.9241, "elle", "None"), "2": (0.6225, "None", "None")}
    assert settings.LEXICON == ("that", "with", "this", "tion")
