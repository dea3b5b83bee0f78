"""Extraction from source-shaped tables, readers and the expansion of quantities."""

import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from yardstar.config import LoadConfig
from yardstar.schemas import STAGING_DDL, staging_schema
from yardstar.sources.extract import EXTRACTS, extract_all, extract_table, tables_of
from yardstar.sources.golden import MOVES, expand_quantities
from yardstar.sources.readers import Split, csv_source, frame_source, jdbc_source, parquet_source

STAMP = datetime(2026, 5, 1, 6)
CFG = LoadConfig(batch_ts=STAMP)


def frames(spark, **tables):
    return frame_source({n: spark.createDataFrame(rows, schema) for n, (rows, schema) in tables.items()})


def rows(df):
    return sorted(tuple(r) for r in df.drop("dt_extracao").collect())


def test_every_staging_table_has_an_extract():
    assert set(EXTRACTS) == set(STAGING_DDL) and len(STAGING_DDL) == 27
    assert [len(tables_of(g)) for g in ("G1", "G2", "G3", "G4")] == [6, 6, 8, 7]


def test_projection_casts_stamps_and_ignores_other_columns(spark):
    src = frames(spark, Patio=([(1, "Centro", 10, "Dona", "x")], "ID_Patio int, Nome_Localizacao string, Capacidade_Vagas int, Empresa_Dona string, Extra string"))
    df = extract_table("g1_patio", src, CFG)
    assert [(f.name, f.dataType) for f in df.schema.fields[:-1]] == [(f.name, f.dataType) for f in staging_schema("g1_patio").fields]
    assert tuple(df.first()) == (1, "Centro", 10, "Dona", STAMP)


def test_char_padding_goes_and_address_is_not_taken(spark):
    schema = "ID_Cliente int, Tipo_Cliente string, Nome_Razao_Social string, CPF_CNPJ string, Endereco_Completo string"
    src = frames(spark, Cliente=([(1, "PF ", "Ana ", "1", "Rua A")], schema))
    assert rows(extract_table("g1_cliente", src, CFG)) == [(1, "PF", "Ana ", "1", None)]


def test_subclasses_flatten_into_one_table(spark):
    src = frames(
        spark,
        cliente=(
            [(1, "PF", "Ana"), (2, "PJ", "Firma"), (3, "PF", "sem cadastro"), (4, "PJ", "pessoa como firma")],
            "id_cliente int, tipo_pessoa string, nome string",
        ),
        cliente_pf=([(1, "11111111111", date(1990, 1, 1)), (4, "4", date(1990, 1, 1))], "cliente_id int, cpf string, data_nascimento date"),
        cliente_pj=([(2, "22222222222222")], "cliente_id int, cnpj string"),
    )
    base = src("cliente").withColumns({c: F.lit(c) for c in ("email", "telefone", "cidade_origem")})
    df = extract_table("g2_cliente", lambda t: base if t == "cliente" else src(t), CFG)
    got = [tuple(r) for r in df.select("id_cliente", "tipo_pessoa", "cpf", "data_nascimento", "cnpj").orderBy("id_cliente").collect()]
    assert got == [(1, "PF", "11111111111", date(1990, 1, 1), None), (2, "PJ", None, None, "22222222222222")]


def test_yards_need_company_and_address(spark):
    src = frames(
        spark,
        Patio=([(1, 1, 1, "Sul"), (2, 9, 1, "sem empresa"), (3, 1, 9, "sem endereço")], "Id_patio int, Id_empresa int, Id_endereco int, Nome_patio string"),
        Empresa=([(1, "Locadora")], "Id_empresa int, Nome_empresa string"),
        Endereco=([(1, "Rio", "RJ ")], "Id_endereco int, Cidade string, UF string"),
    )
    assert rows(extract_table("g3_patio", src, CFG)) == [(1, "Sul", 1, "Locadora", "Rio", "RJ")]


def test_tinyint_is_true_only_for_one(spark):
    vehicle = "Id_veiculo int, Id_grupo int, Id_spec_const int, Categoria string, Marca string, Modelo string, Ano string, Cor string, Chassi string, Placa string"
    src = frames(
        spark,
        Veiculo=([(i, 1, i, "c", "m", "x", "2020", "a", "ch", "pl") for i in (1, 2, 3, 4)], vehicle),
        Especificacoes_const=([(1, 1, 0), (2, 0, 1), (3, None, None), (4, 2, 2)], "Id_spec_const int, Ar_condicionado int, Direcao_automatica int"),
    )
    df = extract_table("g3_veiculo", src, CFG).select("id_veiculo", "ar_condicionado", "direcao_auto").orderBy("id_veiculo")
    assert [tuple(r) for r in df.collect()] == [(1, True, False), (2, False, True), (3, False, False), (4, False, False)]


def test_slot_code_comes_from_its_other_name(spark):
    src = frames(spark, Vaga=([(1, 2, "A-01")], "Id_vaga int, Id_patio int, Alfanum_vaga string"))
    assert rows(extract_table("g3_vaga", src, CFG)) == [(1, "A-01", 2)]


def test_drivers_take_person_and_the_persons_address(spark):
    src = frames(
        spark,
        Motorista=([(1, "cnh", "B", 7)], "IDMotorista int, CNH string, CategoriaCNH string, IDFisica int"),
        PessoaFisica=([(7, "cpf", "Caio", 3)], "IDFisica int, CPF string, Nome string, IDEndereco int"),
        Endereco=([(3, "Rio", "RJ"), (1, "Outra", "SP")], "IDEndereco int, Cidade string, UF string"),
    )
    assert rows(extract_table("g4_motorista", src, CFG)) == [(1, "cpf", "Caio", "cnh", "B", "Rio", "RJ")]


def test_parquet_and_csv_sources_agree(spark):
    folder = tempfile.mkdtemp(prefix="yardstar-src-")
    schema = "ID_Grupo int, Nome_Categoria string, Classe_Luxo string, Valor_Diaria decimal(10,2)"
    groups = spark.createDataFrame([(1, "A"), (2, "B")], "ID_Grupo int, Nome_Categoria string").select(
        "*", F.lit("L").alias("Classe_Luxo"), F.lit("10.50").cast("decimal(10,2)").alias("Valor_Diaria")
    )
    groups.write.parquet(f"{folder}/p/Grupo_Veiculo")
    groups.write.csv(f"{folder}/c/Grupo_Veiculo", header=True)
    a = extract_table("g1_grupo_veiculo", parquet_source(spark, f"{folder}/p"), CFG)
    b = extract_table("g1_grupo_veiculo", csv_source(spark, f"{folder}/c", {"Grupo_Veiculo": schema}), CFG)
    assert rows(a) == rows(b) and a.schema == b.schema and len(rows(a)) == 2


def test_jdbc_reader_splits_a_table(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    read = jdbc_source(Session(), "jdbc:x", {"user": "u"}, "locadora_g2", {"locacao": Split("id_locacao", 1, 1000, 16)})
    with pytest.raises(ValueError, match="no Split for table 'cliente'"):
        read("cliente")
    assert jdbc_source(Session(), "jdbc:x", small={"grupo"})("grupo") == "frame"
    seen.clear()
    assert read("locacao") == "frame"
    assert seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "locadora_g2.locacao",
        "fetchsize": "10000",
        "user": "u",
        "partitionColumn": "id_locacao",
        "lowerBound": 1,
        "upperBound": 1000,
        "numPartitions": 16,
    }


def test_extract_all_names_tables_by_source(spark):
    assert set(extract_all({"G1": lambda t: spark.createDataFrame([], _any(t))}, CFG)) == set(tables_of("G1"))


def _any(table):
    spec = {e.base: t for t, es in EXTRACTS.items() if t.startswith("g1_") for e in es}
    return staging_schema(spec[table])


def test_expand_quantities(spark):
    df = spark.createDataFrame(
        [("x", [1, 2], [3, 4], [2, 1]), ("y", [5, 6, 7], [5, 6, 7], [0, None, 1])],
        "k string, o array<int>, d array<int>, q array<int>",
    )
    got = sorted(tuple(r) for r in expand_quantities(df.where("k = 'x'"), "o", "d", "q").collect())
    assert got == [("x", 1, 3, 1), ("x", 1, 3, 2), ("x", 2, 4, 3)]
    assert [tuple(r) for r in expand_quantities(df.where("k = 'y'"), "o", "d", "q").collect()] == [("y", 7, 7, 1)]


@pytest.mark.parametrize("n", [65_535, 65_536, 65_537, 200_000])
def test_large_quantities_expand_completely(spark, n):
    df = spark.createDataFrame([([1, 2], [3, 4], [n, 2])], "o array<int>, d array<int>, q array<int>")
    got = expand_quantities(df, "o", "d", "q").agg(F.count("*"), F.countDistinct("numero"), F.min("numero"), F.max("numero"))
    assert tuple(got.first()) == (n + 2, n + 2, 1, n + 2)


def test_golden_moves():
    assert sum(q for *_, q in MOVES) == 60
    assert {sum(q for o, _, q in MOVES if o == i) for i in range(1, 7)} == {10}


@pytest.mark.parametrize("grain", ["month", "year"])
def test_next_week_reads_only_its_partitions(spark, grain):
    """The week around New Year lies in two partitions, whatever their size."""
    import contextlib
    import io

    from yardstar.plans.pipeline import load
    from yardstar.plans.reports import report_c_next_week
    from yardstar.sources.golden import golden_staging
    from yardstar.sources.store import Store

    staging = golden_staging(spark)
    day = F.date_add(F.lit("2026-12-20").cast("date"), F.col("id_reserva").cast("int")).cast("timestamp_ntz")
    staging["g1_reserva"] = staging["g1_reserva"].withColumns(
        {"data_hora_retirada_prevista": day, "data_hora_devolucao_prevista": day}
    )
    cfg = LoadConfig(as_of=date(2026, 12, 28), batch_ts=STAMP, partition_grain=grain, stage=False)
    star = load(staging, Store(spark, tempfile.mkdtemp(prefix="yardstar-week-")), cfg)
    df = report_c_next_week(star, cfg.as_of)
    assert df.agg(F.sum("reservas_proxima_semana")).first()[0] == 8
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    assert "periodo_retirada" in text.getvalue().split("PartitionFilters: [")[1].split("PushedFilters")[0]
