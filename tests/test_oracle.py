"""Every registered query against its DuckDB statement at sf0.001."""

import pytest

import __spark_entry__ as entry
from checks import oracle, registry
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), oracle.statements()
DUCK_TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "smallint": {"SMALLINT"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "timestamp": {"TIMESTAMP"},
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    _, found = differences(spark, SF, QUERIES[name], ORACLES[name])
    assert not found


@pytest.mark.parametrize("name", ["lookup_view", "geographic_view", "parse_typed", "batch_files"])
def test_types_match(spark, name):
    mine = dict(QUERIES[name](spark, SF).dtypes)
    described = connect(SF).execute(f"describe {ORACLES[name]}").fetchall()
    for column, kind in [(row[0], row[1]) for row in described]:
        assert kind in DUCK_TYPES[mine[column]], (column, mine[column], kind)


def test_entry(spark):
    result = entry.entry(spark)
    assert len(result.columns) == 19
    assert result.count() > 0
