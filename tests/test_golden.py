"""The 60-rental fixture through the whole pipeline."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from yardstar.plans import markov as M
from yardstar.plans import reports as R

NAMES = [
    "Aeroporto Galeão",
    "Aeroporto Santos Dumont",
    "Barra Shopping",
    "Nova América",
    "Rio Sul",
    "Rodoviária Novo Rio",
]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "table, n",
    [
        ("dim_tempo", 4018),
        ("dim_patio", 6),
        ("dim_grupo_veiculo", 1),
        ("dim_veiculo", 1),
        ("dim_cliente", 1),
        ("dim_empresa", 2),
        ("fato_locacao", 60),
        ("fato_reserva", 60),
        ("fato_patio_snapshot", 6),
    ],
)
def test_row_counts(golden, table, n):
    assert golden[table].count() == n


def test_fact_measures(golden):
    f = golden["fato_locacao"]
    assert f.where("locacao_intercompanhia").count() == 33
    assert f.where("duracao_dias_real = 3 AND duracao_dias_prevista = 3").count() == 60
    assert golden["fato_reserva"].where("duracao_prevista_dias = 3").count() == 60
    assert golden.rejects("fato_locacao").count() == 0
    assert f.select("sk_locacao").distinct().count() == 60


def test_report_a(golden):
    got = rows(R.report_a_latest(golden))
    assert got == [(n, "G1", "Compacto", "BASICO", "PROPRIA", date(2026, 4, 28), 1) for n in NAMES]
    assert rows(R.report_a_yard_control(golden)) == got


def test_report_b(golden):
    assert rows(R.report_b_rental_control(golden, date(2026, 4, 28))) == [
        ("Compacto", "BASICO", "CONCLUIDA", 60, 3.0, 3, 3, None, Decimal("19800.00"))
    ]
    assert rows(R.report_b_monthly(golden)) == [(2026, 5, "May      ", "Compacto", 60, 180, Decimal("19800.00"))]


def test_report_c(golden):
    got = rows(R.report_c_reservations(golden))
    assert got == [("Compacto", n, "NAO_INFORMADO", None, 2026, 5, "May      ", "CONFIRMADA", 10, 3.0) for n in NAMES]


@pytest.mark.parametrize("day, n", [(28, 6), (25, 6), (24, 0)])
def test_next_week_is_eight_days(golden, day, n):
    got = rows(R.report_c_next_week(golden, date(2026, 4, day)))
    assert got == [("Compacto", x, "NAO_INFORMADO", 10) for x in NAMES][:n]


def test_next_week_ends_on_its_first_day(golden):
    assert len(rows(R.report_c_next_week(golden, date(2026, 5, 2)))) == 6
    assert rows(R.report_c_next_week(golden, date(2026, 5, 3))) == []


def test_report_d(golden):
    want = [("NAO_INFORMADO", None, "Compacto", "BASICO", 60, 180, Decimal("19800.00"), Decimal("330.00"))]
    assert rows(R.report_d_group_by_city(golden)) == want
    assert rows(R.report_d_top10(golden)) == want
    assert rows(R.report_d_group_ranking(golden)) == [("Compacto", "BASICO", 60, Decimal("19800.00"))]


@pytest.fixture(scope="module")
def matrix(golden):
    return M.transition_matrix(M.transition_counts(golden)).cache()


def test_matrix(matrix):
    got = {(r[0], r[1]): r[2:] for r in rows(matrix)}
    assert len(got) == 25
    assert {v[1] for v in got.values()} == {10}
    assert got["Aeroporto Galeão", "Barra Shopping"] == (4, 10, Decimal("40.00"), Decimal("0.4000"))


def test_row_check(matrix):
    assert rows(M.row_check(matrix).orderBy("patio_origem")) == [(n, Decimal("1.0000"), "OK ✓") for n in NAMES]
    bad = matrix.where("patio_destino <> 'Barra Shopping'")
    assert dict((r[0], r[2]) for r in rows(M.row_check(bad)))["Rio Sul"] == "ERRO — linha não soma 1"


def test_pivot_has_null_where_nothing_moved(golden, matrix):
    df = M.pivot_matrix(matrix, M.yard_names(golden))
    assert df.columns == ["patio_origem", *NAMES]
    row = df.where("patio_origem = 'Nova América'").first()
    assert tuple(row)[1:] == (Decimal("0.1"), None, Decimal("0.1"), Decimal("0.6"), None, Decimal("0.2"))


# Expected vectors: ten steps, and converged.
TEN = {
    "Barra Shopping": "28.65",
    "Aeroporto Galeão": "22.22",
    "Aeroporto Santos Dumont": "15.04",
    "Rio Sul": "14.92",
    "Nova América": "9.58",
    "Rodoviária Novo Rio": "9.58",
}
CONVERGED = {
    "Barra Shopping": "28.67",
    "Aeroporto Galeão": "22.22",
    "Aeroporto Santos Dumont": "15.05",
    "Rio Sul": "14.93",
    "Nova América": "9.56",
    "Rodoviária Novo Rio": "9.56",
}


@pytest.mark.parametrize("options, want", [({"steps": 10}, TEN), ({"tol": 1e-9}, CONVERGED)])
def test_steady_state(golden, matrix, options, want):
    got = rows(M.steady_state(matrix, golden["dim_patio"], **options))
    assert {r[0]: r[1] for r in got} == {k: Decimal(v) for k, v in want.items()}
    assert all(r[2:] == ((True,) if "tol" in options else ()) for r in got)


@pytest.mark.parametrize("max_steps, b", [(10, "66.67"), (11, "33.33"), (20, "66.67")])
def test_a_chain_that_never_converges_says_so(spark, max_steps, b):
    """A goes to B, B and C go to A: the shares swap for ever."""
    moves = spark.createDataFrame([("A", "B"), ("B", "A"), ("C", "A")], "patio_origem string, patio_destino string")
    matrix = moves.select("*", F.lit("1").cast("decimal(7,4)").alias("probabilidade"))
    yards = spark.createDataFrame([("A",), ("B",), ("C",)], "nome_patio string")
    got = M.steady_state(matrix, yards, tol=1e-9, max_steps=max_steps).collect()
    assert {r.patio: str(r.percentual_equilibrio) for r in got}["B"] == b
    assert not any(r.convergiu for r in got)
    assert [r[1] for r in got] == sorted((r[1] for r in got), reverse=True)
