"""The daily yard snapshot: which available vehicle stands where, own or foreign."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup
from yardstar.schemas import conform_to, star_schema

Frames = Mapping[str, DataFrame]

SPREAD = 1024


def every_yard(vehicles: DataFrame, yards: DataFrame, spread: int = SPREAD) -> DataFrame:
    """Each vehicle paired with all yards of its source (the G1 rule).

    The source tag alone would be one join key for everything, so the yards are
    repeated ``spread`` times and each vehicle meets one of the copies. The hint
    keeps Spark from broadcasting the copies: it estimates their size before
    the repetition.
    """
    v = vehicles.withColumn("__slice", F.pmod(F.xxhash64("sk_veiculo"), F.lit(spread)).cast("int"))
    y = yards.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return v.join(y.hint("merge"), ["fonte_grupo", "__slice"]).drop("__slice")


def snapshot_rows(s: Frames, dims: Frames, as_of: Column) -> DataFrame:
    """Snapshot of G1 and G2; the other sources do not say where a vehicle stands."""
    vehicles = dims["dim_veiculo"].select(
        "fonte_grupo", "id_veiculo_orig", "sk_veiculo", "sk_grupo", F.col("sk_empresa_origem").alias("sk_empresa_veiculo")
    )
    yards = dims["dim_patio"].select("fonte_grupo", "id_patio_orig", "sk_patio", "empresa_dona")

    g1 = vehicles.where(F.col("fonte_grupo") == "G1")
    free = s["g1_veiculo"].where(F.col("status_disponibilidade") == C.G1_AVAILABLE)
    g1 = g1.join(free.select(F.col("id_veiculo").alias("id_veiculo_orig")), "id_veiculo_orig", "left_semi")
    g1 = every_yard(g1, yards.where(F.col("fonte_grupo") == "G1"))
    g1 = lookup(
        g1,
        dims["dim_empresa"],
        {"sk_empresa_veiculo": "sk_empresa"},
        {"nome_empresa": "empresa_veiculo"},
        spread_nulls_by=["sk_veiculo"],
    )

    g2 = lookup(
        vehicles.where(F.col("fonte_grupo") == "G2"),
        s["g2_veiculo"].where(F.col("situacao") == C.G2_AVAILABLE),
        {"id_veiculo_orig": "id_veiculo"},
        {"patio_origem_id": "id_patio"},
        how="inner",
    )
    g2 = lookup(
        g2,
        yards,
        {"fonte_grupo": "fonte_grupo", "id_patio": "id_patio_orig"},
        {"sk_patio": "sk_patio", "empresa_dona": "empresa_dona"},
        how="inner",
    ).withColumn("empresa_veiculo", F.lit(C.G2_COMPANY))

    keep = [
        "fonte_grupo",
        "sk_patio",
        "sk_veiculo",
        "sk_grupo",
        "sk_empresa_veiculo",
        "empresa_dona",
        "empresa_veiculo",
    ]
    both = g1.select(*keep).unionByName(g2.select(*keep))
    both = both.withColumn("origem_veiculo", X.own_or_foreign("empresa_dona", "empresa_veiculo"))
    # One value; NULL when the day is outside the calendar, which then has no snapshot.
    day = dims["dim_tempo"].where(F.col("data_completa") == as_of).select("sk_tempo").scalar()
    dated = both.withColumn("sk_tempo", day).where(F.col("sk_tempo").isNotNull())
    return conform_to(dated, star_schema("fato_patio_snapshot"))
