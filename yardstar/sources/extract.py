"""Extraction: four differently shaped source systems to one staging schema.

Each staging table is described by an ``Extract``: the source table, the
columns whose source name differs, and the inner joins that flatten it. All
reloads are full, as the source scripts' are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardstar.config import LoadConfig
from yardstar.schemas import STAGING_DDL, conform_to, staging_schema
from yardstar.sources.readers import Source


@dataclass(frozen=True)
class Join:
    """Inner join of ``table`` on ``base key == table key``."""

    table: str
    base_key: str
    key: str
    take: tuple[tuple[str, str], ...]  # (staging column, column of the joined table)


@dataclass(frozen=True)
class Extract:
    base: str
    rename: Mapping[str, str] = field(default_factory=dict)  # staging column -> source column
    joins: tuple[Join, ...] = ()
    where: tuple[str, str] | None = None  # (base column, required value)
    blank: tuple[str, ...] = ()  # staging columns the extract leaves NULL
    flags: tuple[str, ...] = ()  # tinyint columns read as booleans
    char: tuple[str, ...] = ()  # blank-padded CHAR(n) columns


# Source table and column names of the four systems. A staging
# column not mentioned has the same name in the source.
EXTRACTS: dict[str, tuple[Extract, ...]] = {
    "g1_patio": (Extract("Patio"),),
    "g1_grupo_veiculo": (Extract("Grupo_Veiculo"),),
    "g1_veiculo": (Extract("Veiculo"),),
    "g1_cliente": (Extract("Cliente", blank=("endereco_completo",), char=("tipo_cliente",)),),
    "g1_reserva": (Extract("Reserva"),),
    "g1_locacao": (Extract("Locacao"),),
    "g2_patio": (Extract("patio"),),
    "g2_grupo": (Extract("grupo"),),
    "g2_veiculo": (Extract("veiculo"),),
    # Superclass with two subclasses: both flatten into one table.
    "g2_cliente": (
        Extract(
            "cliente",
            joins=(
                Join("cliente_pf", "id_cliente", "cliente_id", (("cpf", "cpf"), ("data_nascimento", "data_nascimento"))),
            ),
            where=("tipo_pessoa", "PF"),
            blank=("cnpj",),
        ),
        Extract(
            "cliente",
            joins=(Join("cliente_pj", "id_cliente", "cliente_id", (("cnpj", "cnpj"),)),),
            where=("tipo_pessoa", "PJ"),
            blank=("cpf", "data_nascimento"),
        ),
    ),
    "g2_reserva": (Extract("reserva"),),
    "g2_locacao": (Extract("locacao"),),
    "g3_patio": (
        Extract(
            "Patio",
            joins=(
                Join("Empresa", "Id_empresa", "Id_empresa", (("nome_empresa", "Nome_empresa"),)),
                Join("Endereco", "Id_endereco", "Id_endereco", (("cidade", "Cidade"), ("uf", "UF"))),
            ),
            char=("uf",),
        ),
    ),
    "g3_grupo": (Extract("Grupo"),),
    "g3_veiculo": (
        Extract(
            "Veiculo",
            joins=(
                Join(
                    "Especificacoes_const",
                    "Id_spec_const",
                    "Id_spec_const",
                    (("ar_condicionado", "Ar_condicionado"), ("direcao_auto", "Direcao_automatica")),
                ),
            ),
            flags=("ar_condicionado", "direcao_auto"),
            char=("ano", "chassi", "placa"),
        ),
    ),
    "g3_cliente": (
        Extract(
            "Cliente",
            joins=(
                Join("Documento_cliente", "Id_documento", "Id_documento", (("cpf", "CPF"),)),
                Join("Endereco", "Id_endereco", "Id_endereco", (("cidade", "Cidade"), ("uf", "UF"))),
            ),
            char=("cpf", "uf"),
        ),
    ),
    "g3_reserva": (Extract("Reserva"),),
    "g3_locacao": (Extract("Locacao"),),
    "g3_devolucao": (Extract("Devolucao"),),
    "g3_vaga": (Extract("Vaga", rename={"cod_vaga": "Alfanum_vaga"}),),
    "g4_patio": (
        Extract(
            "Patio",
            rename={
                "id_patio": "IDPatio",
                "cd_patio": "CDPatio",
                "horario_abertura": "HorarioAbertura",
                "horario_fechamento": "HorarioFechamento",
            },
            joins=(
                Join("Endereco", "IDEndereco", "IDEndereco", (("cidade", "Cidade"), ("uf", "UF"))),
                Join("Parceira", "IDParceira", "IDParceira", (("nome_parceira", "Nome"),)),
            ),
            char=("uf",),
        ),
    ),
    "g4_categoria": (
        Extract(
            "Categoria",
            rename={
                "id_categoria": "IDCategoria",
                "classe_luxo": "ClasseLuxo",
                "valor_diaria_base": "ValorDiariaBase",
                "tracao_4x4": "Tracao4x4",
            },
            char=("classe_luxo",),
        ),
    ),
    "g4_veiculo": (
        Extract(
            "Veiculo",
            rename={
                "id_veiculo": "IDVeiculo",
                "ar_condicionado": "ArCondicionado",
                "ultima_km": "UltimaKilometragem",
                "valor_diaria": "ValorDiaria",
                "id_categoria": "IDCategoria",
            },
        ),
    ),
    "g4_motorista": (
        Extract(
            "Motorista",
            rename={"id_motorista": "IDMotorista", "cnh": "CNH", "categoria_cnh": "CategoriaCNH"},
            joins=(
                Join("PessoaFisica", "IDFisica", "IDFisica", (("cpf", "CPF"), ("nome", "Nome"))),
                Join("Endereco", "PessoaFisica.IDEndereco", "IDEndereco", (("cidade", "Cidade"), ("uf", "UF"))),
            ),
            char=("uf",),
        ),
    ),
    "g4_reserva": (
        Extract(
            "Reserva",
            rename={
                "id_reserva": "IDReserva",
                "dt_reserva": "DtReserva",
                "dt_retirada_prevista": "DtRetiradaPrevista",
                "status": "Status",
            },
        ),
    ),
    "g4_locacao": (
        Extract(
            "Locacao",
            rename={
                "id_locacao": "IDLocacao",
                "valor_diaria": "ValorDiaria",
                "dt_retirada": "DtRetirada",
                "dt_chegada": "DtChegada",
                "id_vaga_retirada": "IDVagaRetirada",
                "id_vaga_devolvida": "IDVagaDevolvida",
                "id_veiculo": "IDVeiculo",
                "id_reserva": "IDReserva",
                "id_motorista": "IDMotorista",
            },
        ),
    ),
    "g4_vaga": (Extract("Vaga", rename={"id_vaga": "IDVaga", "cod_vaga": "CodVaga", "id_patio": "IDPatio"}),),
}


def tables_of(source_tag: str) -> list[str]:
    """Staging tables of one source, e.g. ``G3``."""
    return [t for t in STAGING_DDL if t.startswith(source_tag.lower() + "_")]


def _extract_one(spec: Extract, schema: T.StructType, source: Source) -> DataFrame:
    joined = {j.table: source(j.table).alias(j.table) for j in spec.joins}
    df = source(spec.base).alias("base")
    if spec.where:
        df = df.where(F.col(f"base.{spec.where[0]}") == spec.where[1])
    for j in spec.joins:
        base_key = j.base_key if "." in j.base_key else f"base.{j.base_key}"
        df = df.join(joined[j.table], F.col(base_key) == F.col(f"{j.table}.{j.key}"), "inner")
    taken = {name: f"{j.table}.{c}" for j in spec.joins for name, c in j.take}

    def value(name: str) -> str:
        if name in spec.blank:
            return "NULL"
        c = taken.get(name) or f"base.{spec.rename.get(name, name)}"
        if name in spec.flags:
            c = f"coalesce({c} = 1, false)"  # NULL reads as false
        return f"rtrim({c})" if name in spec.char else c

    return df.selectExpr(
        *(f"CAST({value(f.name)} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
    )


def extract_table(table: str, source: Source, cfg: LoadConfig | None = None) -> DataFrame:
    """The staging rows of one table, stamped with the extraction time."""
    cfg = cfg or LoadConfig()
    schema = staging_schema(table)
    parts = [_extract_one(spec, schema, source) for spec in EXTRACTS[table]]
    return reduce(DataFrame.unionByName, parts).withColumn("dt_extracao", cfg.batch_column)


def extract_all(sources: Mapping[str, Source], cfg: LoadConfig | None = None) -> dict[str, DataFrame]:
    """Staging frames of every given source (``{'G1': source, ...}``)."""
    return {t: extract_table(t, src, cfg) for tag, src in sources.items() for t in tables_of(tag)}


def empty_staging(spark, table: str) -> DataFrame:
    """An empty staging table, for a source that is not loaded."""
    return spark.createDataFrame([], staging_schema(table)).withColumn(
        "dt_extracao", F.lit(None).cast("timestamp_ntz")
    )


def complete_staging(spark, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The given staging frames in their declared shape, plus an empty frame per missing table."""
    out = {}
    for table in STAGING_DDL:
        if table not in frames:
            out[table] = empty_staging(spark, table)
            continue
        schema = staging_schema(table).add("dt_extracao", T.TimestampNTZType())
        out[table] = conform_to(frames[table], schema)
    return out
