"""Every registered query against its SQL, and the shape of its plan."""

import contextlib
import io
import re

import pytest
from compare import connect, difference
from conftest import SF

import __spark_entry__ as entry
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert difference(df, con, ORACLES[name]) is None
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    plan = text.getvalue()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan, bad
    # The only window without partitions is the running offset over a key map's partitions.
    for window in re.findall(r"Window \[.*", plan):
        assert "__part" in window or "], [__row#" in window


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["patio_origem", "patio_destino", "total_transicoes", "total_saidas", "percentual", "probabilidade"]
    assert df.count() > 0
