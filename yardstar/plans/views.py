"""SQL names for the warehouse: its tables, reports and forecast as temporary views."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from yardstar.plans import markov as M
from yardstar.plans import reports as R
from yardstar.plans import source_views as V

Frames = Mapping[str, DataFrame]


def warehouse_views(star: Frames, as_of: date | None = None) -> dict[str, DataFrame]:
    """Star tables, the four report views and the three forecast views, by SQL name."""
    counts = M.transition_counts(star)
    return {
        **star,
        "relatorio_a_controle_patio": R.report_a_yard_control(star),
        "relatorio_b_controle_locacoes": R.report_b_rental_control(star, as_of),
        "relatorio_c_controle_reservas": R.report_c_reservations(star),
        "relatorio_d_grupos_por_cidade": R.report_d_group_by_city(star),
        "markov_contagem_transicoes": counts,
        "markov_total_saidas": M.departures(counts),
        "markov_matriz_percentuais": M.transition_matrix(counts),
    }


def g2_views(tables: Frames) -> dict[str, DataFrame]:
    """The five views of source G2, from its tables ``patio grupo veiculo cliente reserva locacao``."""
    t = tables
    return {
        "vw_veiculos_por_patio_grupo": V.vehicles_by_yard(t["veiculo"], t["grupo"], t["patio"]),
        "vw_locacoes_em_andamento": V.active_rentals(t["locacao"], t["veiculo"], t["grupo"]),
        "vw_reservas_por_grupo_patio_cidade": V.open_reservations(t["reserva"], t["grupo"], t["patio"], t["cliente"]),
        "vw_grupos_alugados_por_cidade": V.groups_by_city(t["locacao"], t["cliente"], t["veiculo"], t["grupo"]),
        "vw_movimentacao_patio": V.yard_movements(t["locacao"], t["patio"]),
    }


def register(views: Frames) -> None:
    """Make the frames available to ``spark.sql`` under their names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
