"""Extraction, staging and load from stored source tables, end to end."""

import tempfile
from dataclasses import replace

import pytest
from conftest import SF

from yardstar.plans.pipeline import Warehouse, run
from yardstar.schemas import STAGING_DDL, STAR_DDL, star_schema
from yardstar.sources import testbed as beds
from yardstar.sources.readers import parquet_source
from yardstar.sources.store import Store


@pytest.fixture(scope="module")
def bed(spark):
    return beds.testbed(spark, SF)


@pytest.fixture(scope="module")
def loaded(spark, bed):
    """The role tables written as each system's own tables, then extracted and loaded."""
    root = tempfile.mkdtemp(prefix="yardstar-oltp-")
    systems = {"G1": bed.roles.g1, "G2": bed.roles.g2, "G3": bed.roles.g3, "G4": bed.roles.g4}
    for tag, tables in systems.items():
        for name, df in tables.items():
            df.coalesce(1).write.parquet(f"{root}/{tag}/{name}")
    store = Store(spark, f"{root}/dw")
    return run({tag: parquet_source(spark, f"{root}/{tag}") for tag in systems}, store, replace(beds.CONFIG, stage=True))


def test_staging_is_written(loaded):
    for table in STAGING_DDL:
        assert loaded.store.read(f"staging/{table}", loaded.version).columns[-1] == "dt_extracao"


@pytest.mark.parametrize("table", sorted(STAR_DDL))
def test_same_rows_as_without_staging(loaded, bed, table):
    columns = [f.name for f in star_schema(table).fields]
    a, b = loaded[table].select(*columns), bed.warehouse[table].select(*columns)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_it_is_the_published_version(loaded):
    current = Warehouse.current(loaded.store)
    assert current.version == loaded.version
    last = loaded.store.manifest().collect()
    assert len(last) == 1 and set(last[0]["tables"]) == set(STAR_DDL)


def test_stored_types_are_declared(loaded):
    for table in STAR_DDL:
        stored = {f.name: f.dataType for f in loaded.store.read(table, loaded.version).schema.fields}
        for f in star_schema(table).fields:
            if table == "fato_patio_snapshot" and f.name == "sk_tempo":
                continue  # a partition value: its type comes from the declared schema
            assert stored[f.name] == f.dataType, (table, f.name)
        assert [f.dataType for f in loaded[table].schema.fields if f.name in stored] != []


def test_facts_have_unique_keys(loaded):
    for table, key in (("fato_locacao", "sk_locacao"), ("fato_reserva", "sk_reserva"), ("fato_patio_snapshot", "sk_snapshot")):
        df = loaded[table]
        assert df.select(key).distinct().count() == df.count()
