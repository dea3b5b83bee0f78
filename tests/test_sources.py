"""Conforming, facts and reloads on hand-written tables of all four sources."""

import tempfile
from datetime import date, datetime
from decimal import Decimal

import fixtures
import pytest
from pyspark.sql import functions as F

from yardstar.config import LoadConfig
from yardstar.operators.conform import conform
from yardstar.plans import markov as M
from yardstar.plans.pipeline import Warehouse, daily_snapshot, load
from yardstar.sources.extract import complete_staging
from yardstar.sources.golden import golden_staging
from yardstar.sources.store import Store

CFG = LoadConfig(as_of=date(2026, 4, 1), batch_ts=datetime(2026, 4, 1, 6), partition_grain="year", stage=False)


@pytest.fixture(scope="module")
def staging(spark):
    return {**golden_staging(spark), **fixtures.frames(spark)}


@pytest.fixture(scope="module")
def conformed(spark, staging):
    return conform(complete_staging(spark, staging))


@pytest.fixture(scope="module")
def store(spark):
    return Store(spark, tempfile.mkdtemp(prefix="yardstar-four-"))


@pytest.fixture(scope="module")
def star(staging, store):
    return load(staging, store, CFG)


def by_id(df, key, *cols):
    return {r[0]: tuple(r)[1:] if len(cols) > 1 else r[1] for r in df.select(key, *cols).collect()}


def test_g2_conforming(conformed):
    c = conformed
    assert by_id(c["g2_patio"], "id_patio", "nome") == {1: "CENTRO", 2: "NORTE"}
    assert by_id(c["g2_grupo"], "id_grupo", "classe_luxo") == {1: "BASICO"}
    assert by_id(c["g2_veiculo"], "id_veiculo", "mecanizacao") == {1: "AUTOMATICA", 2: "MANUAL"}
    assert by_id(c["g2_cliente"], "id_cliente", "cidade_origem") == {1: "RIO", 2: "NITERÓI"}
    got = by_id(c["g2_locacao"], "id_locacao", "status", "duracao_dias_real", "duracao_dias_prevista", "km_percorridos")
    assert got == {
        1: ("CONCLUIDA", 3, 4, 50),
        2: ("EM_ANDAMENTO", None, None, None),
        3: ("CANCELADA", 0, 0, 2),
        4: ("CONCLUIDA", 1, None, 2),
    }


def test_g3_conforming(conformed):
    c = conformed
    assert by_id(c["g3_veiculo"], "id_veiculo", "mecanizacao_conf") == {1: "AUTOMATICA", 2: "MANUAL", 3: "MANUAL"}
    assert by_id(c["g3_reserva"], "id_reserva", "status_conformado") == {
        1: "EM_ANDAMENTO",
        2: "CANCELADA",
        3: "CONFIRMADA",
        4: "DESCONHECIDO",
    }
    assert by_id(c["g3_cliente"], "id_cliente", "cidade", "uf") == {1: ("RIO", "RJ")}


def test_g3_yard_and_date_come_from_their_own_first_return(conformed):
    got = by_id(conformed["g3_locacao"], "id_locacao", "id_patio_entrega", "data_devolucao", "status_conformado")
    assert got == {
        1: (2, datetime(2026, 2, 2, 8), "CONCLUIDA"),
        2: (None, datetime(2026, 2, 5, 9), "CONCLUIDA"),
        3: (None, None, "EM_ANDAMENTO"),
        4: (None, None, "EM_ANDAMENTO"),
    }


def test_g4_conforming(conformed):
    c = conformed
    assert by_id(c["g4_categoria"], "id_categoria", "classe_luxo_conf") == {
        1: "BASICO",
        2: "INTERMEDIARIO",
        3: "LUXO",
        4: "DESCONHECIDO",
    }
    got = by_id(c["g4_locacao"], "id_locacao", "id_patio_retirada", "id_patio_entrega", "duracao_dias_real", "status_conformado")
    assert got == {1: (1, 1, 0, "CONCLUIDA"), 2: (1, None, None, "EM_ANDAMENTO"), 3: (None, 1, 4, "CONCLUIDA"), 4: (1, 1, 4, "CONCLUIDA")}


def test_rental_facts(star):
    got = {
        (r[0], r[1]): tuple(r)[2:]
        for r in star["fato_locacao"]
        .where("fonte_grupo <> 'G1'")
        .select(
            "fonte_grupo",
            "id_locacao_orig",
            "duracao_dias_prevista",
            "duracao_dias_real",
            "valor_diaria",
            "valor_total",
            "km_percorridos",
            "locacao_intercompanhia",
            "status_locacao",
        )
        .collect()
    }
    d = Decimal
    assert got == {
        ("G2", 1): (4, 3, d("90.00"), d("270.00"), 50, True, "CONCLUIDA"),
        ("G2", 2): (None, None, d("80.00"), None, None, False, "EM_ANDAMENTO"),
        ("G2", 3): (0, 0, d("70.00"), d("0.00"), 2, False, "CANCELADA"),
        ("G3", 1): (3, 0, d("300.00"), d("900.00"), None, True, "CONCLUIDA"),
        ("G3", 2): (3, 4, d("300.00"), d("900.00"), None, True, "CONCLUIDA"),
        ("G3", 3): (3, None, d("300.00"), d("900.00"), None, True, "EM_ANDAMENTO"),
        ("G4", 1): (None, 0, d("55.00"), d("0.00"), None, False, "CONCLUIDA"),
        ("G4", 2): (None, None, d("55.00"), None, None, True, "EM_ANDAMENTO"),
    }


def test_rejects_say_why(star):
    got = {(r[0], r[1]): r[2] for r in star.rejects("fato_locacao").collect()}
    assert got == {
        ("G2", 4): ["DATA_RETIRADA"],
        ("G3", 4): ["CLIENTE"],
        ("G4", 3): ["PATIO_RETIRADA"],
        ("G4", 4): ["VEICULO"],
    }


def test_facts_and_rejects_are_all_staged_rows(star, staging):
    n = sum(staging[f"{g}_locacao"].count() for g in ("g1", "g2", "g3", "g4"))
    assert star["fato_locacao"].count() + star.rejects("fato_locacao").count() == n
    n = sum(staging[f"{g}_reserva"].count() for g in ("g1", "g2", "g3"))
    assert star["fato_reserva"].count() + star.rejects("fato_reserva").count() == n


def test_reservation_with_unknown_return_yard_is_kept(star):
    got = star["fato_reserva"].where("fonte_grupo = 'G2' AND id_reserva_orig = 2").first()
    assert got["sk_patio_devolucao"] is None and got["duracao_prevista_dias"] == 0


def test_dimensions(star):
    vehicles = {(r[0], r[1]): tuple(r)[2:] for r in star["dim_veiculo"].select(
        "fonte_grupo", "id_veiculo_orig", "ano_fabricacao", "mecanizacao", F.col("sk_empresa_origem").isNotNull()).collect()}
    assert vehicles == {
        ("G1", 101): (None, "MANUAL", False),
        ("G2", 1): (2020, "AUTOMATICA", True),
        ("G2", 2): (2021, "MANUAL", True),
        ("G3", 1): (2019, "AUTOMATICA", False),
        ("G3", 2): (2020, "MANUAL", False),
        ("G3", 3): (None, "MANUAL", False),
        ("G4", 1): (2022, None, False),
    }
    clients = {(r[0], r[1]): tuple(r)[2:] for r in star["dim_cliente"].select(
        "fonte_grupo", "id_cliente_orig", "tipo_pessoa", "cpf_cnpj", "cidade_origem", "uf_origem").collect()}
    assert clients == {
        ("G1", 501): ("PF", "00000000191", "NAO_INFORMADO", None),
        ("G2", 1): ("PF", "11111111111", "RIO", None),
        ("G2", 2): ("PJ", "22222222222222", "NITERÓI", None),
        ("G3", 1): ("PF", "33333333333", "RIO", "RJ"),
        ("G4", 1): ("PF", "44444444444", "NITERÓI", "RJ"),
    }


def test_snapshot_has_g2_at_home_yards_and_nothing_of_g3_g4(star):
    rows = star["fato_patio_snapshot"].groupBy("fonte_grupo", "origem_veiculo").count().collect()
    assert {tuple(r) for r in rows} == {("G1", "PROPRIA", 6), ("G2", "PROPRIA", 1)}


def test_yards_with_one_name_merge_only_if_spelled_alike(star):
    counts = {(r[0], r[1]): r[2] for r in M.transition_counts(star).collect()}
    assert counts["CENTRO", "NORTE"] == 1
    assert counts["Sul", "Leste"] == 1
    assert counts["P-01", "P-01"] == 1


def test_keys_are_dense_and_kept_on_reload(spark, star, staging, store):
    first = {t: {tuple(r)[:-1]: r[-1] for r in star.key_map(t).collect()} for t in ("dim_patio", "dim_cliente", "dim_tempo")}
    for keys in first.values():
        assert sorted(keys.values()) == list(range(1, len(keys) + 1))
    assert [first["dim_patio"][k] for k in sorted(first["dim_patio"])] == sorted(first["dim_patio"].values())
    more = staging["g1_patio"].unionByName(
        staging["g1_patio"].limit(1).withColumn("id_patio", F.lit(0).cast("bigint")).withColumn("nome_localizacao", F.lit("Novo"))
    )
    again = load({**staging, "g1_patio": more}, store, CFG)
    assert again.version != star.version and Warehouse.current(store).version == again.version
    keys = {tuple(r)[:-1]: r[-1] for r in again.key_map("dim_patio").collect()}
    assert keys == {**first["dim_patio"], ("G1", 0): len(first["dim_patio"]) + 1}
    assert again["dim_patio"].count() == star["dim_patio"].count() + 1
    # A client that is gone leaves the dimension but keeps its key.
    gone = load({**staging, "g4_motorista": staging["g4_motorista"].limit(0)}, store, CFG)
    assert gone["dim_cliente"].count() == star["dim_cliente"].count() - 1
    assert gone.key_map("dim_cliente").count() == len(first["dim_cliente"])


def test_an_unpublished_version_is_not_seen(spark, star, store):
    before = store.current()
    store.write(spark.range(3), "dim_patio", store.begin())
    assert store.current() == before


def test_daily_snapshot_replaces_only_its_day(staging, star):
    n = star["fato_patio_snapshot"].count()
    next_day = LoadConfig(as_of=date(2026, 4, 2), batch_ts=CFG.batch_ts)
    for _ in range(2):
        daily_snapshot(staging, star, next_day)
        assert star["fato_patio_snapshot"].count() == 2 * n
    assert star["fato_patio_snapshot"].select("sk_snapshot").distinct().count() == 2 * n


def test_snapshot_outside_the_calendar_is_empty(staging, store):
    late = LoadConfig(as_of=date(2031, 1, 1), batch_ts=CFG.batch_ts, partition_grain="year", stage=False)
    assert load(staging, store, late)["fato_patio_snapshot"].count() == 0
