"""The golden fixture: 60 rentals whose movements give a known matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstar.schemas import conform_to, staging_schema

# Yards, and movements as (origin, destination, quantity).
YARDS = [
    (1, "Aeroporto Galeão", 120, "G1"),
    (2, "Aeroporto Santos Dumont", 80, "G1"),
    (3, "Barra Shopping", 150, "G1"),
    (4, "Nova América", 100, "G1"),
    (5, "Rio Sul", 90, "G1"),
    (6, "Rodoviária Novo Rio", 70, "G1"),
]
MOVES = [
    (1, 1, 3), (1, 2, 1), (1, 3, 4), (1, 5, 2),
    (2, 2, 4), (2, 1, 2), (2, 5, 3), (2, 3, 1),
    (3, 3, 5), (3, 1, 2), (3, 2, 1), (3, 4, 1), (3, 6, 1),
    (4, 4, 6), (4, 6, 2), (4, 1, 1), (4, 3, 1),
    (5, 5, 4), (5, 1, 2), (5, 2, 2), (5, 3, 2),
    (6, 6, 5), (6, 1, 3), (6, 2, 1), (6, 4, 1),
]


UNITS_AT_ONCE = 65_536


def expand_quantities(df: DataFrame, origins: str, destinations: str, quantities: str) -> DataFrame:
    """One row per unit of three parallel arrays, numbered 1..n within its input row.

    Adds ``origem``, ``destino`` and ``numero``; the arrays are dropped, other
    columns stay. The number is the sum of the quantities before, a running sum
    over the row's elements, plus the unit. Quantities are opened in blocks,
    which are dealt out before they become rows: one row with a very large
    quantity is the work of several tasks.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c not in (origins, destinations, quantities)]
    moves = F.arrays_zip(F.col(origins).alias("o"), F.col(destinations).alias("d"), F.col(quantities).alias("q"))
    moved = df.select(*keep, F.monotonically_increasing_id().alias("__row"), moves.alias("__moves"))
    moved = moved.select(*keep, "__row", F.posexplode("__moves").alias("__i", "__m"))
    count, block = F.col("__m.q").cast("bigint"), F.col("__block")
    earlier = Window.partitionBy("__row").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.greatest(F.coalesce(count, F.lit(0)), F.lit(0))).over(earlier), F.lit(0))
    blocks = F.when(count > 0, F.sequence(F.lit(1).cast("bigint"), count, F.lit(UNITS_AT_ONCE).cast("bigint")))
    units = F.sequence(block, F.least(block + (UNITS_AT_ONCE - 1), count))
    return (
        moved.withColumn("__before", before)
        .withColumn("__block", F.explode(blocks))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__row", "__i", "__block")
        .withColumn("__unit", F.explode(units))
        .select(
            *keep,
            F.col("__m.o").alias("origem"),
            F.col("__m.d").alias("destino"),
            (F.col("__before") + F.col("__unit")).alias("numero"),
        )
    )


def golden_staging(spark: SparkSession) -> dict[str, DataFrame]:
    """Staging tables of G1 with one client, one vehicle and 60 rentals.

    Fixed values: yards, ids, dates and amounts, which the expected results depend on.
    """
    yards = spark.createDataFrame(YARDS, "id_patio bigint, nome_localizacao string, capacidade_vagas int, empresa_dona string")
    one = spark.range(1)

    def lit(value, kind: str) -> Column:
        return F.lit(value).cast(kind)

    groups = one.select(
        F.lit(1).alias("id_grupo"),
        F.lit("Compacto").alias("nome_categoria"),
        F.lit("BASICO").alias("classe_luxo"),
        F.lit("110.00").alias("valor_diaria"),
    )
    vehicles = one.select(
        F.lit(101).alias("id_veiculo"),
        F.lit(1).alias("id_grupo"),
        F.lit("YRD0A01").alias("placa"),
        F.lit("YARDSTARGOLDEN001").alias("chassi"),
        F.lit("Marca").alias("marca"),
        F.lit("Modelo").alias("modelo"),
        F.lit("Verde").alias("cor"),
        F.lit(True).alias("ar_condicionado"),
        F.lit("MANUAL").alias("mecanizacao"),
        F.lit("Disponível").alias("status_disponibilidade"),
    )
    clients = one.select(
        F.lit(501).alias("id_cliente"),
        F.lit("PF").alias("tipo_cliente"),
        F.lit("Cliente um").alias("nome_razao_social"),
        F.lit("00000000191").alias("cpf_cnpj"),
        F.lit("Rua um, 1").alias("endereco_completo"),
    )
    arrays = one.select(
        *(F.array(*(F.lit(m[i]) for m in MOVES)).alias(n) for i, n in enumerate(("origens", "destinos", "quantidades")))
    )
    moves = expand_quantities(arrays, "origens", "destinos", "quantidades")
    reservations = moves.select(
        F.col("numero").alias("id_reserva"),
        F.lit(501).alias("id_cliente"),
        F.lit(1).alias("id_grupo"),
        F.col("origem").alias("id_patio_retirada"),
        lit("2026-05-01 08:00:00", "timestamp_ntz").alias("data_hora_solicitacao"),
        lit("2026-05-02 09:00:00", "timestamp_ntz").alias("data_hora_retirada_prevista"),
        lit("2026-05-05 18:00:00", "timestamp_ntz").alias("data_hora_devolucao_prevista"),
        F.lit("CONFIRMADA").alias("status_reserva"),
    )
    rentals = moves.select(
        F.col("numero").alias("id_locacao"),
        F.col("numero").alias("id_reserva"),
        F.lit(101).alias("id_veiculo"),
        F.col("origem").alias("id_patio_saida"),
        F.col("destino").alias("id_patio_chegada_prevista"),
        F.col("destino").alias("id_patio_chegada_realizada"),
        lit("2026-05-02 09:15:00", "timestamp_ntz").alias("data_hora_retirada"),
        lit("2026-05-05 18:00:00", "timestamp_ntz").alias("data_hora_devolucao_prevista"),
        lit("2026-05-05 17:45:00", "timestamp_ntz").alias("data_hora_devolucao_realizada"),
        F.lit("330.00").alias("valor_inicial"),
        F.lit("330.00").alias("valor_final"),
    )
    frames = {
        "g1_patio": yards,
        "g1_grupo_veiculo": groups,
        "g1_veiculo": vehicles,
        "g1_cliente": clients,
        "g1_reserva": reservations,
        "g1_locacao": rentals,
    }
    return {t: conform_to(df, staging_schema(t)) for t, df in frames.items()}
