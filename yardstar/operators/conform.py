"""Conforming rules per source: text, codes, durations and indirect lookups.

Every function takes staging frames by table name and returns the frames the
rules change; the rest pass through. One projection per table replaces a
column-by-column rewrite.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup

Frames = Mapping[str, DataFrame]


def conform_g1(s: Frames) -> dict[str, DataFrame]:
    out_ts, in_ts, due_ts = (
        "data_hora_retirada",
        "data_hora_devolucao_realizada",
        "data_hora_devolucao_prevista",
    )
    return {
        "g1_patio": s["g1_patio"].withColumn("nome_localizacao", F.trim("nome_localizacao")),
        "g1_veiculo": s["g1_veiculo"].withColumn("mecanizacao", X.transmission_from_text("mecanizacao")),
        "g1_reserva": s["g1_reserva"].withColumn("status_reserva", X.upper_trim("status_reserva")),
        "g1_locacao": s["g1_locacao"].withColumns(
            {
                "status_conformado": X.status_from_return(in_ts),
                "duracao_dias_real": X.whole_days(out_ts, in_ts),
                "duracao_dias_prevista": X.whole_days(out_ts, due_ts),
            }
        ),
    }


def planned_days_from_reservation(rentals: DataFrame, reservations: DataFrame) -> DataFrame:
    """Planned days of the reservation a rental refers to; NULL without a match.

    Should a reservation appear twice, its shortest plan counts.
    """
    days = X.whole_days("data_retirada_prevista", "data_devolucao_prevista")
    return lookup(
        rentals,
        reservations.withColumn("dias", days),
        {"reserva_id": "id_reserva"},
        {"dias": "duracao_dias_prevista"},
        spread_nulls_by=["id_locacao"],
        lowest=True,
    )


def conform_g2(s: Frames) -> dict[str, DataFrame]:
    rentals = planned_days_from_reservation(s["g2_locacao"], s["g2_reserva"]).withColumns(
        {
            "status": X.upper_trim("status"),
            "duracao_dias_real": X.whole_days("data_retirada_real", "data_devolucao_real"),
            "km_percorridos": F.col("km_chegada") - F.col("km_saida"),
        }
    )
    return {
        "g2_patio": s["g2_patio"].withColumn("nome", X.upper_trim("nome")),
        "g2_grupo": s["g2_grupo"].withColumn("classe_luxo", X.upper_trim("classe_luxo")),
        "g2_veiculo": s["g2_veiculo"].withColumn("mecanizacao", X.upper_trim("mecanizacao")),
        "g2_cliente": s["g2_cliente"].withColumn("cidade_origem", X.upper_trim("cidade_origem")),
        "g2_locacao": rentals,
    }


def resolve_returns(rentals: DataFrame, returns: DataFrame, slots: DataFrame) -> DataFrame:
    """Return yard and return date of every rental.

    Each is the lowest-numbered return that satisfies its own lookup: the yard
    needs a known slot, the date does not. Both come from one aggregation.
    """
    with_yard = lookup(
        returns, slots, {"id_vaga": "id_vaga"}, {"id_vaga": "vaga", "id_patio": "patio"}, lowest=True, hot=True
    )
    first = with_yard.groupBy("id_locacao").agg(
        F.min_by("patio", F.when(F.col("vaga").isNotNull(), F.col("id_devolucao"))).alias("patio"),
        F.min_by("data_devolucao", "id_devolucao").alias("data"),
    )
    return lookup(
        rentals,
        first,
        {"id_locacao": "id_locacao"},
        {"patio": "id_patio_entrega", "data": "data_devolucao"},
    )


def conform_g3(s: Frames) -> dict[str, DataFrame]:
    rentals = resolve_returns(s["g3_locacao"], s["g3_devolucao"], s["g3_vaga"])
    return {
        "g3_patio": s["g3_patio"].withColumns({"cidade": X.upper_trim("cidade"), "uf": X.upper_trim("uf")}),
        "g3_cliente": s["g3_cliente"].withColumns({"cidade": X.upper_trim("cidade"), "uf": X.upper_trim("uf")}),
        "g3_veiculo": s["g3_veiculo"].withColumn("mecanizacao_conf", X.transmission_from_flag("direcao_auto")),
        "g3_reserva": s["g3_reserva"].withColumns(
            {
                "status_conformado": X.recode("estado_reserva", C.G3_RESERVATION_CODES),
                "duracao_prevista_dias": X.whole_days("data_inicio_combinada", "data_fim_combinada"),
            }
        ),
        "g3_locacao": rentals.withColumns(
            {
                "status_conformado": X.status_from_return("data_devolucao"),
                "duracao_dias_real": X.whole_days("data_locacao", "data_devolucao"),
            }
        ),
    }


def resolve_slots(rentals: DataFrame, slots: DataFrame) -> DataFrame:
    """Pickup and return yards from the slots a rental names (the lowest, should a slot appear twice)."""
    # Reduced once: both joins read the same shuffled result.
    yards = slots.groupBy("id_vaga").agg(F.min("id_patio").alias("id_patio"))
    for slot, yard in (("id_vaga_retirada", "id_patio_retirada"), ("id_vaga_devolvida", "id_patio_entrega")):
        rentals = lookup(rentals, yards, {slot: "id_vaga"}, {"id_patio": yard}, spread_nulls_by=["id_locacao"])
    return rentals


def conform_g4(s: Frames) -> dict[str, DataFrame]:
    return {
        "g4_patio": s["g4_patio"].withColumns({"cidade": X.upper_trim("cidade"), "uf": X.upper_trim("uf")}),
        "g4_motorista": s["g4_motorista"].withColumns({"cidade": X.upper_trim("cidade"), "uf": X.upper_trim("uf")}),
        "g4_categoria": s["g4_categoria"].withColumn("classe_luxo_conf", X.recode("classe_luxo", C.LUXURY_LETTERS)),
        "g4_locacao": resolve_slots(s["g4_locacao"], s["g4_vaga"]).withColumns(
            {
                "status_conformado": X.status_from_return("dt_chegada"),
                "duracao_dias_real": X.whole_days("dt_retirada", "dt_chegada"),
            }
        ),
    }


def conform(staging: Frames) -> dict[str, DataFrame]:
    """All staging tables after the rules of their source."""
    out = dict(staging)
    for rules in (conform_g1, conform_g2, conform_g3, conform_g4):
        out.update(rules(staging))
    return out
