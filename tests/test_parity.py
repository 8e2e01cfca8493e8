"""Every registered query against its DuckDB statement at sf0.001."""

import pytest

from matrix_help import SF001

import parity

_CON = {}


def _con():
    if "c" not in _CON:
        _CON["c"] = parity.duck(SF001)
    return _CON["c"]


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    from __spark_entry__ import oracle_sql
    report = parity.compare(spark, SF001, [name], con=_con())[name]
    assert report["rows"] > 0
    if name in oracle_sql():
        assert report["cols_match"]
        assert report["diffs"] == 0, report


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["vec_id", "j", "value"]
    assert df.count() == 500 * 64
