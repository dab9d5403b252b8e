"""Every registered query against its SQL on the smallest supplied tables.

ORACLE_DIR names another folder; ORACLE_FAMILY limits the run to names with that prefix.
"""

import os

import pytest

import __spark_entry__ as entry
from noticeloom.plans import catalog
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
FAMILY = os.environ.get("ORACLE_FAMILY", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_of_the_catalog_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(entry.queries()) >= set(entry.oracle_sql()) >= set(catalog.SQL)


@pytest.mark.parametrize("name", [n for n in catalog.SQL if n.startswith(FAMILY)])
def test_matches_sql(utc, duck, name):
    mine, want = compare(utc, duck, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert mine[0] == want[0]
    assert mine[1] == want[1]
