"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from stockcast.plans import oracles, queries as registry, round_trip_oracles, round_trips

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


#: Hundreds of rounds; compare.py runs it, and test_model_sources.py tests the same loop on few rows.
LONG = {"train_reference_settings"}


@pytest.mark.parametrize("name", [n for n in registry.registered() | round_trips.registered() if n not in LONG])
def test_query_matches_sql(spark, con, name):
    equal, _, message = compare(spark, con, FOLDER, name)
    assert equal is not False, message


def test_every_query_has_sql():
    assert set(registry.registered()) == set(oracles.oracle_sql())
    assert set(round_trips.registered()) == set(round_trip_oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 26
