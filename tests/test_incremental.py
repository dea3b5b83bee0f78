"""Incremental extraction and the commits of the store: what changes, what is shared, and two runs at once."""

import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from yardstar.plans.pipeline import Warehouse
from yardstar.sources.incremental import StagingTable, Tracked
from yardstar.sources.store import Layer, Store, create_once

T0 = datetime(2026, 1, 1)
SCHEMA = "id long, part int, name string, tags array<string>, changed timestamp_ntz"
TRACKED = Tracked("clients", ("id", "part"), "changed", "INTERVAL 1 DAY", buckets=8)


@pytest.fixture
def table(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="yardstar-extract-"))
    return StagingTable(store, TRACKED, spark.createDataFrame([], SCHEMA).schema)


def frame(spark, rows):
    return spark.createDataFrame([(i, p, n, ["x", None], c) for i, p, n, c in rows], SCHEMA)


def names(table):
    return {(r.id, r.part): r.name for r in table.current().collect()}


def day(n):
    return T0 + timedelta(days=n)


def test_two_extracts_equal_a_full_reload(spark, table):
    rows = {(i, i % 2): (i, i % 2, f"n{i}", day(0)) for i in range(200)} | {(None, 1): (None, 1, "no id", day(0))}
    first = table.extract(frame(spark, rows.values()))
    assert (first.inserted, first.updated, first.deleted) == (201, 0, 0)
    parts = table._entry()["parts"]
    rows[(3, 1)] = (3, 1, "changed", day(5))
    rows[(900, 0)] = (900, 0, "new", day(5))
    rows[(None, 1)] = (None, 1, "still no id", day(5))
    second = table.extract(frame(spark, rows.values()))
    assert (second.inserted, second.updated) == (1, 2)
    assert names(table) == {k: v[2] for k, v in rows.items()}
    now = table._entry()["parts"]
    same = [b for b in parts if now[b] == parts[b]]
    assert {int(b) for b in parts} - {int(b) for b in same} <= set(second.buckets) and len(same) >= 5
    assert table._entry()["mark"].startswith("2026-01-06")


def test_only_rows_from_the_mark_less_the_overlap_are_read(spark, table):
    table.extract(frame(spark, [(1, 0, "a", day(10)), (2, 0, "b", day(10))]))
    # Row 1 was changed behind the mark's back, long before it; row 2 within the overlap.
    late = [(1, 0, "unseen", day(2)), (2, 0, "late", day(9) + timedelta(hours=12)), (3, 0, "undated", None)]
    found = table.extract(frame(spark, late))
    assert (found.inserted, found.updated) == (1, 1)
    assert names(table) == {(1, 0): "a", (2, 0): "late", (3, 0): "undated"}


def test_the_filter_reaches_the_source(spark, table, tmp_path):
    frame(spark, [(i, 0, "a", day(i)) for i in range(50)]).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    table.extract(source)
    since = F.expr(f"CAST('{table._entry()['mark']}' AS TIMESTAMP_NTZ) - {TRACKED.overlap}")
    plan = source.where((F.col("changed") >= since) | F.col("changed").isNull())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(changed" in plan


def test_an_extract_without_a_change_publishes_nothing(spark, table):
    rows = [(1, 0, "a", day(1)), (2, 0, "b", day(1))]
    table.extract(frame(spark, rows))
    before = table._entry()
    again = table.extract(frame(spark, rows))
    assert (again.inserted, again.updated, again.deleted, again.buckets) == (0, 0, 0, ())
    assert table._entry() == before


def test_deletions_are_found_by_keys(spark, table):
    table.extract(frame(spark, [(i, 0, "a", day(1)) for i in range(40)]))
    left = [(i, 0, "a", day(1)) for i in range(1, 40)]
    assert table.extract(frame(spark, left)).deleted == 0 and len(names(table)) == 40
    found = table.extract(frame(spark, left), find_deleted=True)
    assert found.deleted == 1 and set(names(table)) == {(i, 0) for i in range(1, 40)}
    assert table.extract(frame(spark, []), find_deleted=True).deleted == 39
    assert names(table) == {}
    assert table.extract(frame(spark, left)).inserted == 39


def test_a_key_that_comes_twice_counts_once_with_its_latest_change(spark, table):
    table.extract(frame(spark, [(1, 0, "old", day(1)), (1, 0, "new", day(2)), (1, 0, "undated", None)] * 3))
    assert names(table) == {(1, 0): "new"}


def test_the_second_of_two_extracts_at_once_fails(spark, table):
    table.extract(frame(spark, [(1, 0, "a", day(1))]))
    seen = table._entry()
    table.store.commit("clients", {"version": "x", "mark": seen["mark"], "parts": seen["parts"]}, seen)
    table._entry = lambda: seen
    with pytest.raises(RuntimeError, match="another run"):
        table.extract(frame(spark, [(2, 0, "b", day(2))]))
    del table._entry
    assert names(table) == {(1, 0): "a"}


def test_extracts_of_an_empty_source(spark, table):
    assert table.extract(frame(spark, [])).inserted == 0
    assert names(table) == {}
    assert table.extract(frame(spark, [(1, 0, "a", None)]), find_deleted=True).inserted == 1


# -- the store's commits --------------------------------------------------------------


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "m" / "1.json")
    assert create_once(spark, path, "first") and not create_once(spark, f"file://{path}", "second")
    with open(path) as f:
        assert f.read() == "first"
    assert os.listdir(tmp_path / "m") == ["1.json"]


def test_of_two_loads_from_one_version_one_is_published(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish("v-1", ["t"])
    a, b = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    last = a._last()
    a._last = b._last = lambda: last  # both have looked before either published
    a.publish("v-2", ["t"], "v-1")
    with pytest.raises(RuntimeError, match="just been published"):
        b.publish("v-3", ["t"], "v-1")
    assert store.current() == "v-2"


def test_layers_share_partitions_with_older_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    days = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "day long, v string")
    store.write(days, "t", "v-1", ("day",))
    store.write(spark.createDataFrame([(9,)], "n long"), "other", "v-1")
    store.publish("v-1", ["t", "other"])
    store.write(spark.createDataFrame([(2, "new")], "day long, v string"), "t", "v-2", ("day",))
    half_way = store.read("t", schema=days.schema)
    assert sorted(tuple(r) for r in half_way.select("day", "v").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    store.publish("v-2", ["t", "other"], "v-1", "v-1", [Layer("t", "v-1", "day", [1, 3]), Layer("t", "v-2", "day", [2])])
    got = sorted(tuple(r) for r in store.read("t", schema=days.schema).select("day", "v").collect())
    assert got == [(1, "a"), (2, "new"), (3, "c")]
    assert store.read("other").collect()[0].n == 9
    assert sorted(r.v for r in Store(spark, str(tmp_path)).read("t", "v-1", days.schema).collect()) == ["a", "b", "c"]
    assert isinstance(Warehouse(store, "v-2").version, str)
