"""Increments of a loaded warehouse: late members settle rejects exactly once."""

import tempfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import frames
from pyspark.sql import functions as F

from yardstar.config import LoadConfig
from yardstar.plans.pipeline import Warehouse, daily_snapshot, increment, load
from yardstar.schemas import staging_schema
from yardstar.sources.store import Store

CFG = LoadConfig(as_of=date(2026, 4, 28), batch_ts=datetime(2026, 4, 28, 6), stage=False)
NATURAL = ["fonte_grupo", "id_locacao_orig", "valor_diaria", "valor_total", "status_locacao", "duracao_dias_real"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def facts_of(star):
    return rows(star["fato_locacao"].select(*NATURAL))


def why(star, table="fato_locacao"):
    return {(r[0], r[1]): r[2] for r in star.rejects(table).collect()}


@pytest.fixture(scope="module")
def staging(spark):
    return {t: df.withColumn("dt_extracao", F.lit(None).cast("timestamp_ntz")) for t, df in frames(spark).items()}


@pytest.fixture(scope="module")
def whole(spark, staging):
    return load(staging, Store(spark, tempfile.mkdtemp(prefix="yardstar-whole-")), CFG)


@pytest.fixture(scope="module")
def settled(spark, staging):
    """A load without the clients of G2 and G3, the increment that brings them, and the same increment again."""
    lacking = {t: df for t, df in staging.items() if t not in ("g2_cliente", "g3_cliente")}
    late = {t: staging[t] for t in ("g2_cliente", "g3_cliente")}
    store = Store(spark, tempfile.mkdtemp(prefix="yardstar-late-"))
    first = load(lacking, store, CFG)
    second = increment(late, first, CFG)
    return first, second, increment(late, second, CFG)


def test_a_late_client_turns_its_reject_into_one_fact(settled, whole):
    first, second, _ = settled
    assert {k for k, v in why(first).items() if "CLIENTE" in v} == {("G2", i) for i in (1, 2, 3, 4)} | {("G3", i) for i in (1, 2, 3, 4)}
    assert facts_of(second) == facts_of(whole)
    assert why(second) == why(whole)
    assert why(second, "fato_reserva") == why(whole, "fato_reserva")
    assert second["fato_reserva"].count() == whole["fato_reserva"].count() > first["fato_reserva"].count()


def test_the_version_before_stays_as_it_was(settled):
    first = settled[0]
    assert {r[0] for r in facts_of(first)} == {"G4"}
    assert len(why(first)) == 10


def test_the_same_increment_again_changes_nothing(settled):
    _, second, third = settled
    columns = [c for c in second["fato_locacao"].columns if c != "dt_carga"]
    assert rows(third["fato_locacao"].select(*columns)) == rows(second["fato_locacao"].select(*columns))
    assert why(third) == why(second)
    for t in ("dim_cliente", "dim_veiculo", "dim_empresa", "dim_patio", "dim_tempo"):
        own = [c for c in second[t].columns if c != "dt_carga"]
        assert rows(third[t].select(*own)) == rows(second[t].select(*own)), t


def test_members_that_a_batch_lacks_are_kept_with_their_keys(settled):
    first, second, _ = settled
    for t, key in (("dim_veiculo", "sk_veiculo"), ("dim_patio", "sk_patio"), ("dim_cliente", "sk_cliente")):
        old = {r[key]: r.asDict() for r in first[t].drop("dt_carga").collect()}
        new = {r[key]: r.asDict() for r in second[t].drop("dt_carga").collect()}
        assert {k: new[k] for k in old} == old
    assert rows(second["fato_patio_snapshot"]) == rows(first["fato_patio_snapshot"])


def test_fact_keys_stay_unique(settled):
    for star in settled:
        for table, key in (("fato_locacao", "sk_locacao"), ("fato_reserva", "sk_reserva")):
            assert star[table].select(key).distinct().count() == star[table].count()


def test_accepted_files_are_shared(settled):
    first, second, third = settled
    base, layers = second.store.place(second.version)
    assert base == second.version
    assert [x.versao for x in layers if x.tabela == "fato_locacao"] == [first.version, second.version]
    # The third accepted nothing; the second's own layer now counts for its facts alone.
    last = [x for x in third.store.place(third.version)[1] if x.tabela == "fato_locacao"]
    assert [(x.versao, x.onde is None) for x in last] == [(first.version, False), (second.version, False), (third.version, True)]


def test_new_rows_repeated_rows_and_rows_without_an_id(spark, staging, settled):
    star = settled[2]
    d, t = Decimal, datetime
    new = (9, None, 1, 1, 1, 2, t(2026, 1, 8, 8), t(2026, 1, 9, 9), 10, 30, d("90.00"), "CONCLUIDA")
    seen = (1, 1, 1, 1, 1, 2, t(2026, 1, 2, 8), t(2026, 1, 5, 9), 100, 999, d("1.00"), "CONCLUIDA")
    nameless = (None, *new[1:])
    again = (4, *new[1:])  # takes the place of a reject
    batch = spark.createDataFrame([new, new, seen, nameless, nameless, again], staging_schema("g2_locacao"))
    after = increment({"g2_locacao": batch}, star, CFG)
    # Rows that share a key all count, as in a whole load.
    added = [r for r in facts_of(after) if r not in facts_of(star)]
    assert sorted(r[1] for r in added) == [4, 9, 9] and len(facts_of(after)) == len(facts_of(star)) + 3
    assert why(after) == {k: v for k, v in why(star).items() if k != ("G2", 4)} | {("G2", None): ["ID"]}
    once_more = increment({"g2_locacao": batch}, after, CFG)
    assert facts_of(once_more) == facts_of(after) and once_more.rejects("fato_locacao").count() == len(why(after))
    # A daily snapshot of a version in layers keeps the layers of the facts.
    day = LoadConfig(as_of=date(2026, 4, 29), batch_ts=CFG.batch_ts, stage=False)
    before = once_more["fato_patio_snapshot"].count()
    written = daily_snapshot(staging, once_more, day).count()
    assert written and once_more["fato_patio_snapshot"].count() == before + written
    assert facts_of(once_more) == facts_of(after)


def test_of_two_increments_from_one_version_one_is_refused(spark, staging):
    store = Store(spark, tempfile.mkdtemp(prefix="yardstar-two-"))
    first = load({t: df for t, df in staging.items() if t != "g2_cliente"}, store, CFG)
    increment({"g2_cliente": staging["g2_cliente"]}, first, CFG)
    with pytest.raises(RuntimeError, match="another load"):
        increment({"g2_cliente": staging["g2_cliente"]}, first, CFG)
    assert Warehouse.current(store)["fato_locacao"].where("fonte_grupo = 'G2'").count() == 3
