"""Edge cases of the conforming expressions and lookups."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup


def one(spark, expr, schema="x string", *values):
    return spark.createDataFrame([values], schema).select(expr).first()[0]


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2026-05-02 09:15:00", "2026-05-05 17:45:00", 3),
        ("2026-05-02 09:15:00", "2026-05-03 09:14:00", 0),
        ("2026-05-02 09:15:00", "2026-05-03 09:15:00", 1),
        ("2026-05-05 17:45:00", "2026-05-02 09:15:00", -3),
        ("2026-05-05 09:00:00", "2026-05-04 10:00:00", 0),
        ("2026-01-30 00:00:00", "2026-05-05 00:00:00", 95),
        ("2026-05-02 09:15:00", None, None),
        (None, "2026-05-02 09:15:00", None),
    ],
)
def test_whole_days(spark, start, end, want):
    ts = [datetime.fromisoformat(t) if t else None for t in (start, end)]
    assert one(spark, X.whole_days("a", "b"), "a timestamp_ntz, b timestamp_ntz", *ts) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("auto", "AUTOMATICA"),
        (" Automático ", "AUTOMATICA"),
        ("AUTOMÁTICA", "AUTOMATICA"),
        ("automatica", "AUTOMATICA"),
        ("Automatico", "AUTOMATICA"),
        ("manual", "MANUAL"),
        ("semi-auto", "MANUAL"),
        (None, "MANUAL"),
    ],
)
def test_transmission_text(spark, raw, want):
    assert one(spark, X.transmission_from_text("x"), "x string", raw) == want


@pytest.mark.parametrize("raw, want", [(True, "AUTOMATICA"), (False, "MANUAL"), (None, "MANUAL")])
def test_transmission_flag(spark, raw, want):
    assert one(spark, X.transmission_from_flag("x"), "x boolean", raw) == want


@pytest.mark.parametrize(
    "code, want", [(0, "EM_ANDAMENTO"), (1, "CANCELADA"), (2, "CONFIRMADA"), (7, "DESCONHECIDO"), (None, "DESCONHECIDO")]
)
def test_reservation_codes(spark, code, want):
    assert one(spark, X.recode("x", C.G3_RESERVATION_CODES), "x int", code) == want


@pytest.mark.parametrize(
    "letter, want",
    [("A", "BASICO"), ("B", "INTERMEDIARIO"), ("C", "LUXO"), ("D", "DESCONHECIDO"), ("a", "DESCONHECIDO"), (None, "DESCONHECIDO")],
)
def test_luxury_letters(spark, letter, want):
    assert one(spark, X.recode("x", C.LUXURY_LETTERS), "x string", letter) == want


@pytest.mark.parametrize(
    "a, b, want", [(1, 1, False), (1, 2, True), (1, None, True), (None, 1, True), (None, None, False)]
)
def test_differs_is_null_safe(spark, a, b, want):
    assert one(spark, X.differs("a", "b"), "a int, b int", a, b) is want


@pytest.mark.parametrize(
    "owner, company, want",
    [("X", "X", "PROPRIA"), ("X", None, "PROPRIA"), ("X", "Y", "EXTERNA"), (None, None, "EXTERNA"), (None, "Y", "EXTERNA")],
)
def test_own_or_foreign(spark, owner, company, want):
    assert one(spark, X.own_or_foreign("a", "b"), "a string, b string", owner, company) == want


def test_padded_names(spark):
    d = F.lit("2026-05-01").cast("date")
    row = spark.range(1).select(X.padded_name(d, "EEEE"), X.padded_name(d, "MMMM")).first()
    assert tuple(row) == ("Friday   ", "May      ")


def test_trim_keeps_case_and_strips_blanks_only(spark):
    assert one(spark, F.trim("x"), "x string", "  Nova América ") == "Nova América"
    assert one(spark, X.upper_trim("x"), "x string", " são paulo ") == "SÃO PAULO"


@pytest.mark.parametrize("spread", [(), ("id",)])
def test_lookup_keeps_unmatched_and_null_keys(spark, spread):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, k int")
    right = spark.createDataFrame([(10, "a"), (None, "n")], "k int, v string")
    got = lookup(left, right, {"k": "k"}, {"v": "nome"}, spread_nulls_by=spread)
    assert got.columns == ["id", "k", "nome"]
    assert {tuple(r) for r in got.collect()} == {(1, 10, "a"), (2, 20, None), (3, None, None)}
    inner = lookup(left, right, {"k": "k"}, {"v": "nome"}, "inner", spread_nulls_by=spread)
    assert {tuple(r) for r in inner.collect()} == {(1, 10, "a")}


def test_null_keys_match_only_where_asked(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    plain = lookup(left, right, {"k": "k"}, {"v": "v"}, spread_nulls_by=["id"])
    assert sorted((r.id, r.v) for r in plain.collect()) == [(1, 10), (2, None)]
    safe = lookup(left, right, {"k": "k"}, {"v": "v"}, "inner", null_safe=True)
    assert sorted((r.id, r.v) for r in safe.collect()) == [(1, 10), (2, 20)]


def test_a_company_without_a_name_keeps_its_row(spark):
    from yardstar.operators.dims import keyed

    rows = spark.createDataFrame([("G3", 1, "X"), ("G3", 2, None)], "fonte_grupo string, id_empresa_orig bigint, nome_empresa string")
    keys = spark.createDataFrame([("G3", "X", 7), ("G3", None, 8)], "fonte_grupo string, nome_empresa string, sk bigint")
    got = keyed(rows, keys, "dim_empresa").collect()
    assert sorted((r.sk_empresa, r.nome_empresa or "") for r in got) == [(7, "X"), (8, "")]
