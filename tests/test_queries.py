"""Every registered query against its SQL."""

import pytest

import __spark_entry__
from checks.compare import database, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_registration():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) - set(ORACLES) == {
        "fit_hashing_metrics",
        "fit_vocab_metrics",
        "score_requests",
        "score_saved_model",
        "score_stream",
        "full_analysis",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLES[name]) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6


def test_scoring_paths_agree(spark):
    tables = [QUERIES[n](spark, SF) for n in ("score_requests", "score_saved_model", "score_stream")]
    assert tables[0].count() > 0
    for other in tables[1:]:
        assert other.count() == tables[0].count()
        assert other.select(*tables[0].columns).exceptAll(tables[0]).count() == 0
