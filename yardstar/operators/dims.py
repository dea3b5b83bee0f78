"""The six dimensions.

Each ``*_rows`` function lays the four sources out in one shape, without a
surrogate key; ``keyed`` adds the key from a key map.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup
from yardstar.schemas import conform_to, star_schema

# Natural key and surrogate key of each dimension.
NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "dim_tempo": ("data_completa",),
    "dim_empresa": ("fonte_grupo", "nome_empresa"),
    "dim_patio": ("fonte_grupo", "id_patio_orig"),
    "dim_grupo_veiculo": ("fonte_grupo", "id_grupo_orig"),
    "dim_veiculo": ("fonte_grupo", "id_veiculo_orig"),
    "dim_cliente": ("fonte_grupo", "id_cliente_orig"),
}
SURROGATE = {
    "dim_tempo": "sk_tempo",
    "dim_empresa": "sk_empresa",
    "dim_patio": "sk_patio",
    "dim_grupo_veiculo": "sk_grupo",
    "dim_veiculo": "sk_veiculo",
    "dim_cliente": "sk_cliente",
}

Frames = Mapping[str, DataFrame]


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _shape(df: DataFrame, tag: str, **cols: str | Column) -> DataFrame:
    return df.select(
        *((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in cols.items()),
        F.lit(tag).alias("fonte_grupo"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def date_bounds(spark: SparkSession, start: date = C.CALENDAR_START, end: date = C.CALENDAR_END) -> DataFrame:
    """The calendar's first and last day as one row."""
    return spark.range(1).select(F.lit(start).alias("inicio"), F.lit(end).alias("fim"))


def date_rows(bounds: DataFrame) -> DataFrame:
    """One row per day from ``inicio`` to ``fim`` with its attributes (ISO week, 1 = Sunday)."""
    d = F.col("data_completa")
    month, weekday = F.month(d), F.dayofweek(d)
    days = bounds.select(F.explode(F.sequence("inicio", "fim", F.expr("interval 1 day"))).alias("data_completa"))
    return days.select(
        d,
        F.dayofmonth(d).alias("dia"),
        month.alias("mes"),
        F.quarter(d).alias("trimestre"),
        F.when(month <= 6, 1).otherwise(2).alias("semestre"),
        F.year(d).alias("ano"),
        F.weekofyear(d).alias("num_semana_ano"),
        weekday.alias("dia_semana_num"),
        X.padded_name(d, "EEEE").alias("dia_semana_nome"),
        X.padded_name(d, "MMMM").alias("nome_mes"),
        weekday.isin(1, 7).alias("eh_fim_semana"),
    )


def company_rows(s: Frames) -> DataFrame:
    """One row per company. Names are made distinct before they are numbered.

    G1 and G4 have no company ids: they are numbered by ``number_companies``.
    """
    spark = s["g1_patio"].sparkSession
    none = _null("bigint")
    return _union(
        [
            _shape(s["g1_patio"], "G1", id_empresa_orig=none, nome_empresa="empresa_dona").distinct(),
            _shape(spark.range(1), "G2", id_empresa_orig=none, nome_empresa=F.lit(C.G2_COMPANY)),
            _shape(s["g3_patio"], "G3", id_empresa_orig="id_empresa", nome_empresa="nome_empresa").distinct(),
            _shape(s["g4_patio"], "G4", id_empresa_orig=none, nome_empresa="nome_parceira").distinct(),
        ]
    )


def number_companies(companies: DataFrame) -> DataFrame:
    """Number the companies of G1 and G4 within their source.

    The number is the distance from the source's lowest surrogate key: 1..n on
    a first load, and as stable as the key on later ones.
    """
    lowest = companies.groupBy("fonte_grupo").agg(F.min("sk_empresa").alias("menor"))
    numbered = lookup(companies, lowest, {"fonte_grupo": "fonte_grupo"}, {"menor": "__menor"})
    return numbered.withColumn(
        "id_empresa_orig",
        F.when(F.col("fonte_grupo").isin("G1", "G4"), F.col("sk_empresa") - F.col("__menor") + 1).otherwise(
            F.col("id_empresa_orig")
        ),
    ).drop("__menor")


def yard_rows(s: Frames) -> DataFrame:
    return _union(
        [
            _shape(
                s["g1_patio"],
                "G1",
                id_patio_orig="id_patio",
                nome_patio="nome_localizacao",
                empresa_dona="empresa_dona",
                cidade=_null(),
                uf=_null(),
            ),
            _shape(
                s["g2_patio"],
                "G2",
                id_patio_orig="id_patio",
                nome_patio="nome",
                empresa_dona=F.lit(C.G2_COMPANY),
                cidade=_null(),
                uf=_null(),
            ),
            _shape(
                s["g3_patio"],
                "G3",
                id_patio_orig="id_patio",
                nome_patio="nome_patio",
                empresa_dona="nome_empresa",
                cidade="cidade",
                uf="uf",
            ),
            _shape(
                s["g4_patio"],
                "G4",
                id_patio_orig="id_patio",
                nome_patio="cd_patio",
                empresa_dona="nome_parceira",
                cidade="cidade",
                uf="uf",
            ),
        ]
    )


def group_rows(s: Frames) -> DataFrame:
    return _union(
        [
            _shape(
                s["g1_grupo_veiculo"],
                "G1",
                id_grupo_orig="id_grupo",
                codigo_grupo=_null(),
                nome_grupo="nome_categoria",
                classe_luxo="classe_luxo",
                valor_diaria="valor_diaria",
            ),
            _shape(
                s["g2_grupo"],
                "G2",
                id_grupo_orig="id_grupo",
                codigo_grupo="codigo",
                nome_grupo="nome",
                classe_luxo="classe_luxo",
                valor_diaria="valor_diaria",
            ),
            _shape(
                s["g3_grupo"],
                "G3",
                id_grupo_orig="id_grupo",
                codigo_grupo=_null(),
                nome_grupo="nome",
                classe_luxo=_null(),
                valor_diaria="diaria_grupo",
            ),
            _shape(
                s["g4_categoria"],
                "G4",
                id_grupo_orig="id_categoria",
                codigo_grupo=_null(),
                nome_grupo="classificacao",
                classe_luxo="classe_luxo_conf",
                valor_diaria="valor_diaria_base",
            ),
        ]
    )


def vehicle_rows(s: Frames, groups: DataFrame, companies: DataFrame) -> DataFrame:
    """Vehicles whose group is known, with the keys of their group and company.

    Only G2 names a company; a NULL company never matches.
    """
    no_text, no_int = _null(), _null("int")
    vehicles = _union(
        [
            _shape(
                s["g1_veiculo"],
                "G1",
                id_veiculo_orig="id_veiculo",
                placa="placa",
                chassi="chassi",
                marca="marca",
                modelo="modelo",
                ano_fabricacao=no_int,
                cor="cor",
                mecanizacao="mecanizacao",
                ar_condicionado="ar_condicionado",
                id_grupo="id_grupo",
                empresa=no_text,
            ),
            _shape(
                s["g2_veiculo"],
                "G2",
                id_veiculo_orig="id_veiculo",
                placa="placa",
                chassi="chassi",
                marca="marca",
                modelo="modelo",
                ano_fabricacao="ano_fabricacao",
                cor="cor",
                mecanizacao="mecanizacao",
                ar_condicionado="tem_ar_condicionado",
                id_grupo="grupo_id",
                empresa=F.lit(C.G2_COMPANY),
            ),
            _shape(
                s["g3_veiculo"],
                "G3",
                id_veiculo_orig="id_veiculo",
                placa="placa",
                chassi="chassi",
                marca="marca",
                modelo="modelo",
                ano_fabricacao=F.col("ano").cast("int"),
                cor="cor",
                mecanizacao="mecanizacao_conf",
                ar_condicionado="ar_condicionado",
                id_grupo="id_grupo",
                empresa=no_text,
            ),
            _shape(
                s["g4_veiculo"],
                "G4",
                id_veiculo_orig="id_veiculo",
                placa="placa",
                chassi="chassi",
                marca=no_text,
                modelo="modelo",
                ano_fabricacao="ano",
                cor=no_text,
                mecanizacao=no_text,
                ar_condicionado="ar_condicionado",
                id_grupo="id_categoria",
                empresa=no_text,
            ),
        ]
    )
    with_group = lookup(
        vehicles,
        groups,
        {"fonte_grupo": "fonte_grupo", "id_grupo": "id_grupo_orig"},
        {"sk_grupo": "sk_grupo"},
        how="inner",
    )
    return lookup(
        with_group,
        companies,
        {"fonte_grupo": "fonte_grupo", "empresa": "nome_empresa"},
        {"sk_empresa": "sk_empresa_origem"},
        spread_nulls_by=["id_veiculo_orig"],
    ).drop("id_grupo", "empresa")


def client_rows(s: Frames) -> DataFrame:
    return _union(
        [
            _shape(
                s["g1_cliente"],
                "G1",
                id_cliente_orig="id_cliente",
                nome="nome_razao_social",
                tipo_pessoa="tipo_cliente",
                cpf_cnpj="cpf_cnpj",
                cidade_origem=F.lit(C.CITY_UNKNOWN),
                uf_origem=_null(),
            ),
            _shape(
                s["g2_cliente"],
                "G2",
                id_cliente_orig="id_cliente",
                nome="nome",
                tipo_pessoa="tipo_pessoa",
                cpf_cnpj=F.coalesce("cpf", "cnpj"),
                cidade_origem="cidade_origem",
                uf_origem=_null(),
            ),
            _shape(
                s["g3_cliente"],
                "G3",
                id_cliente_orig="id_cliente",
                nome="nome_completo",
                tipo_pessoa=F.lit("PF"),
                cpf_cnpj="cpf",
                cidade_origem="cidade",
                uf_origem="uf",
            ),
            _shape(
                s["g4_motorista"],
                "G4",
                id_cliente_orig="id_motorista",
                nome="nome",
                tipo_pessoa=F.lit("PF"),
                cpf_cnpj="cpf",
                cidade_origem="cidade",
                uf_origem="uf",
            ),
        ]
    )


def keyed(rows: DataFrame, key_map: DataFrame, table: str) -> DataFrame:
    """Add the surrogate key and put the columns in their declared order."""
    keys, sk = NATURAL_KEYS[table], SURROGATE[table]
    df = lookup(rows, key_map, {k: k for k in keys}, {"sk": sk}, how="inner", null_safe=True)
    if table == "dim_empresa":
        df = number_companies(df)
    return conform_to(df, star_schema(table))
