"""Rules on small tables with known faults."""

from datetime import date, datetime

import pytest

from yardstar.operators import audits as Q
from yardstar.operators.rules import CATALOG, LICENCES, UNITS


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    assert found(Q.audit_unique(df, ["k"], "u")) == [("u", "a", "2")]


def test_composite_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "x int, k string")
    assert found(Q.audit_unique(df, ["x", "k"], "u")) == [("u", "1|a", "2")]


def test_orphans_allow_null(spark):
    child = spark.createDataFrame([(1,), (None,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert found(Q.audit_orphans(child, "fk", parent, "pk", "r")) == [("r", "9", "2")]


RULES = [
    *Q.required("a"),
    Q.one_of("s", "X", "Y"),
    Q.at_least("n", 0),
    Q.above("p", 0),
    Q.after("t2", "t1"),
    Q.not_before("k2", "k1"),
    Q.length("c", 3, 4),
    Q.without("c", "IOQ"),
    Q.at_most("w", 2),
    Q.any_of("doc", "d1", "d2"),
    Q.exactly_one("dono", "d1", "d2"),
    Q.past("b"),
    Q.not_future("f"),
]
SCHEMA = (
    "id int, a string, s string, n int, p int, t1 timestamp_ntz, t2 timestamp_ntz, k1 int, k2 int, c string, "
    "w string, d1 string, d2 string, b date, f date"
)
DAY = date(2026, 1, 10)
OK = (1, "a", "X", 0, 1, datetime(2026, 1, 1), datetime(2026, 1, 2), 5, 5, "ABC", "zz", "d", None, date(2026, 1, 9), DAY)
NULLS = (2, "a", *[None] * 9, None, "d", None, None)
BAD = (3, None, "Z", -1, 0, datetime(2026, 1, 2), datetime(2026, 1, 2), 5, 4, "oi", "zzz", None, None, DAY, date(2026, 1, 11))


def test_row_rules_in_one_pass(spark):
    df = spark.createDataFrame([OK, NULLS, BAD], SCHEMA)
    got = Q.audit_rows(df, ["id"], RULES, "t:", DAY)
    assert found(got) == [
        ("t:algum:doc", "3", "d1,d2"),
        ("t:dominio:s", "3", "Z"),
        ("t:exclusivo:dono", "3", ""),
        ("t:faixa:n", "3", "-1"),
        ("t:faixa:p", "3", "0"),
        ("t:futuro:b", "3", "2026-01-10"),
        ("t:futuro:f", "3", "2026-01-11"),
        ("t:largura:w", "3", "zzz"),
        ("t:obrigatorio:a", "3", "a"),
        ("t:ordem:k2", "3", "4 < 5"),
        ("t:ordem:t2", "3", "2026-01-02 00:00:00 <= 2026-01-02 00:00:00"),
        ("t:padrao:c", "3", "oi"),
        ("t:tamanho:c", "3", "oi"),
    ]


def test_both_documents_are_not_exactly_one(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, d1 string, d2 string")
    assert found(Q.audit_rows(df, ["id"], [Q.exactly_one("dono", "d1", "d2")])) == [("exclusivo:dono", "1", "x,y")]


def test_one_active(spark):
    df = spark.createDataFrame([(1, "EM_ANDAMENTO"), (1, "EM_ANDAMENTO"), (1, "CONCLUIDA"), (2, "EM_ANDAMENTO")], "v int, s string")
    assert found(Q.audit_one_active(df, "v", "s", "EM_ANDAMENTO", "um")) == [("um", "1", "2")]


def test_catalogue_on_one_table(spark):
    rentals = spark.createDataFrame(
        [
            (1, 1, 1, 5, 10, "EM_ANDAMENTO"),
            (2, 2, 1, 5, 4, "EM_ANDAMENTO"),
            (2, None, 8, -1, None, "PERDIDA"),
        ],
        "id_locacao int, reserva_id int, veiculo_id int, km_saida int, km_chegada int, status string",
    )
    tables = {"G2.locacao": rentals, "G2.veiculo": spark.createDataFrame([(1,)], "id_veiculo int")}
    everything = Q.audit_table("G2.locacao", CATALOG["G2.locacao"], tables)
    got = [r[:2] for r in found(everything.where("chave IS NOT NULL"))]
    unchecked = {r.regra: r.detalhe for r in everything.where("chave IS NULL").collect()}
    assert unchecked["G2.locacao:referencia:reserva_id"] == "não verificada: G2.reserva"
    assert any(detail != "não verificada: G2.reserva" for detail in unchecked.values())
    assert got == [
        ("G2.locacao:dominio:status", "2"),
        ("G2.locacao:faixa:km_saida", "2"),
        ("G2.locacao:ordem:km_chegada", "2"),
        ("G2.locacao:referencia:veiculo_id", "8"),
        ("G2.locacao:um_ativo:veiculo_id", "1"),
        ("G2.locacao:unico:id_locacao", "2"),
    ]


def test_rules_of_absent_tables_are_named(spark):
    tables = {"G2.veiculo": spark.createDataFrame([(1,)], "id_veiculo int")}
    got = {r.regra: r.nao_verificada for r in Q.summary(Q.audit_all(CATALOG, tables, absent=True)).collect()}
    absent = {rule for n, r in CATALOG.items() if n not in tables for rule in Q.rule_names(n, r)}
    assert absent and all(got[rule] for rule in absent)
    assert Q.summary(Q.audit_all(CATALOG, {}, absent=True)).where("NOT nao_verificada").count() == 0


def test_the_golden_warehouse_breaks_no_rule(golden):
    tables = {f"DW.{t}": df for t, df in golden.items()}
    assert Q.summary(Q.audit_all(CATALOG, tables)).where("violacoes > 0 OR nao_verificada").count() == 0


def test_widths_are_audited_not_enforced(spark):
    df = spark.createDataFrame([(1, "X" * 18, "p")], "sk_veiculo int, chassi string, placa string")
    everything = Q.audit_table("DW.dim_veiculo", CATALOG["DW.dim_veiculo"], {"DW.dim_veiculo": df})
    got = found(everything.where("chave IS NOT NULL"))
    assert got == [("DW.dim_veiculo:largura:chassi", "1", "X" * 18)]


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_catalogue_is_consistent(name):
    source = name.split(".")[0]
    for parent, key in CATALOG[name].references.values():
        assert parent.split(".")[0] == source
        assert CATALOG[parent].key == (key,)


def test_fixed_lists():
    assert len(UNITS) == len(set(UNITS)) == 27 and len(LICENCES) == 9


def _shuffles(df):
    """Rows are moved by these exchanges of the finished plan; reused ones move none."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]


def test_a_key_that_is_unique_and_referred_to_is_shuffled_once(spark, tmp_path):
    spark.range(50).selectExpr("id AS pk", "id % 7 AS fk").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    rules = Q.TableRules(key=("pk",), unique=(("fk",),), references={"fk": ("t", "pk")})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.audit_table("t", rules, {"t": t})
        assert len([line for line in _shuffles(df) if "hashpartitioning(fk#" in line]) == 1
        assert len(found(df)) == 7 and {r[0] for r in found(df)} == {"t:unico:fk"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_are_counted_in_their_own_types(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "b", None)], "id bigint, k string, n int")
    got = Q.audit_uniques(df, {"i": ["id"], "k": ["k"], "kn": ["k", "n"], "n": ["n"]})
    assert found(got) == [("i", "1", "2"), ("k", "b", "2"), ("n", "5", "2")]
    lines = _shuffles(got)
    assert len(lines) == 4 and not [line for line in lines if "struct" in line or "hashpartitioning(e#" in line]
