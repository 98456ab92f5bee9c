import pytest

from workload.catalogue import ORACLES, QUERIES
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twin():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, twin, name):
    verdict = compare(QUERIES[name](spark, SF), twin, ORACLES[name])
    assert verdict.startswith(("exact", "close")), verdict


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["city", "severity", "anomaly_count"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
