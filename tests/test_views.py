"""The warehouse and source views under their SQL names."""

from datetime import date
from decimal import Decimal

import fixtures
import pytest

from yardstar.operators.conform import conform_g2
from yardstar.plans.views import g2_views, register, warehouse_views


@pytest.fixture(scope="module")
def sql(spark, golden):
    register(warehouse_views(golden, date(2026, 4, 28)))
    return lambda text: [tuple(r) for r in spark.sql(text).collect()]


@pytest.mark.parametrize(
    "text, n",
    [
        ("SELECT * FROM markov_matriz_percentuais", 25),
        ("SELECT * FROM relatorio_a_controle_patio", 6),
        ("SELECT * FROM dim_patio", 6),
        ("SELECT * FROM dim_cliente WHERE fonte_grupo = 'G1'", 1),
        ("SELECT * FROM relatorio_b_controle_locacoes", 1),
        ("SELECT * FROM relatorio_c_controle_reservas", 6),
        ("SELECT * FROM relatorio_d_grupos_por_cidade LIMIT 10", 1),
        ("SELECT * FROM markov_total_saidas WHERE total_saidas = 10", 6),
        ("SELECT * FROM markov_contagem_transicoes", 25),
    ],
)
def test_rows(sql, text, n):
    assert len(sql(text)) == n


def test_rental_count(sql):
    assert sql("SELECT count(*) FROM fato_locacao") == [(60,)]


def test_row_sums(sql):
    got = sql("SELECT patio_origem, sum(probabilidade) AS soma FROM markov_matriz_percentuais GROUP BY patio_origem")
    assert {s for _, s in got} == {Decimal("1.0000")}


def test_latest_snapshot_in_sql(sql):
    latest = (
        "SELECT * FROM relatorio_a_controle_patio WHERE data_snapshot = (SELECT max(data_completa) FROM dim_tempo "
        "WHERE sk_tempo IN (SELECT sk_tempo FROM fato_patio_snapshot))"
    )
    assert len(sql(latest)) == 6


def test_g2_views(spark):
    staged = fixtures.frames(spark)
    tables = {**staged, **conform_g2(staged)}
    views = g2_views({t: tables[f"g2_{t}"] for t in ("patio", "grupo", "veiculo", "cliente", "reserva", "locacao")})
    got = {name: sorted(tuple(r) for r in df.collect()) for name, df in views.items()}
    assert got == {
        "vw_veiculos_por_patio_grupo": [("CENTRO", "EC", 1)],
        "vw_locacoes_em_andamento": [("EC", 1)],
        "vw_reservas_por_grupo_patio_cidade": [("EC", "CENTRO", "RIO", 1), ("EC", "NORTE", "NITERÓI", 1)],
        "vw_grupos_alugados_por_cidade": [("NITERÓI", "EC", 3), ("RIO", "EC", 1)],
        "vw_movimentacao_patio": [("CENTRO", "CENTRO", 1), ("CENTRO", "NORTE", 1)],
    }
