"""Rental and reservation facts.

The sources are laid out in one shape first, so every dimension is joined once
for all of them. Dimensions are left-joined and each missing mandatory one adds
a reason: rows without reasons are the fact, the others are its rejects. The
mandatory ones are exactly those the source scripts inner-join (or declare NOT
NULL): pickup date, client, vehicle (with its group) and pickup yard for
rentals; three dates, client, group and pickup yard for reservations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup
from yardstar.schemas import conform_to, star_schema

Frames = Mapping[str, DataFrame]

MONEY = "decimal(10,2)"

# The columns of the laid-out rows: what a rejected row needs to be resolved again.
ROW_DDL = {
    "fato_locacao": "id_locacao_orig BIGINT, data_retirada DATE, data_devolucao DATE, id_cliente BIGINT, id_veiculo BIGINT, "
    "id_patio_retirada BIGINT, id_patio_entrega BIGINT, duracao_dias_prevista INT, duracao_dias_real INT, "
    "valor_diaria DECIMAL(10,2), valor_total DECIMAL(10,2), km_percorridos INT, status_locacao STRING, "
    "locacao_intercompanhia BOOLEAN, fonte_grupo STRING",
    "fato_reserva": "id_reserva_orig BIGINT, data_solicitacao DATE, data_retirada DATE, data_devolucao DATE, "
    "id_cliente BIGINT, id_grupo BIGINT, id_patio_retirada BIGINT, id_patio_devolucao BIGINT, "
    "duracao_prevista_dias INT, status_reserva STRING, fonte_grupo STRING",
}

CLIENT = {"sk_cliente": "sk_cliente"}


def _rental(df: DataFrame, tag: str, kept: Sequence[str] = (), **cols: str | Column | None) -> DataFrame:
    kinds = {
        "id_locacao_orig": None,
        "data_retirada": "date",
        "data_devolucao": "date",
        "id_cliente": "bigint",
        "id_veiculo": "bigint",
        "id_patio_retirada": "bigint",
        "id_patio_entrega": "bigint",
        "duracao_dias_prevista": "int",
        "duracao_dias_real": "int",
        "valor_diaria": MONEY,
        "valor_total": MONEY,
        "km_percorridos": "int",
        "status_locacao": "string",
    }
    out = []
    for name, kind in kinds.items():
        c = cols.get(name)
        c = F.lit(None) if c is None else X.col(c)
        out.append((c.cast(kind) if kind else c).alias(name))
    out.append(X.differs(cols["id_patio_retirada"], cols["id_patio_entrega"]).alias("locacao_intercompanhia"))
    return df.select(*out, F.lit(tag).alias("fonte_grupo"), *kept)


def _with_reservation(laid: DataFrame, reservations: DataFrame, take: Mapping[str, str]) -> DataFrame:
    """Laid-out rentals, which are narrower than their source's, with what their reservation says."""
    row = [*T.StructType.fromDDL(ROW_DDL["fato_locacao"]).names, *(n for n in take.values() if n in CLIENT)]
    df = laid.drop(*take.values())
    df = lookup(df, reservations, {"id_reserva": "id_reserva"}, take, spread_nulls_by=["id_locacao_orig"])
    return df.select(*row)


def _with_client(rows: DataFrame, clients: DataFrame, tag: str, spread_by: str) -> DataFrame:
    """Reservations of one source with the key of their client."""
    tagged = rows.withColumn("fonte_grupo", F.lit(tag))
    return _source_key(tagged, clients, "id_cliente", "id_cliente_orig", CLIENT, spread_by)


def rentals_g1(s: Frames, clients: DataFrame | None = None) -> DataFrame:
    """The client comes from the reservation (the lowest, should one appear twice): walk-ins have none."""
    reservations = s["g1_reserva"].groupBy("id_reserva").agg(F.min("id_cliente").alias("id_cliente"))
    take = {"id_cliente": "id_cliente"}
    if clients is not None:
        reservations, take = _with_client(reservations, clients, "G1", "id_reserva"), take | CLIENT
    laid = _rental(
        s["g1_locacao"],
        "G1",
        ["id_reserva"],
        id_locacao_orig="id_locacao",
        data_retirada="data_hora_retirada",
        data_devolucao="data_hora_devolucao_realizada",
        id_veiculo="id_veiculo",
        id_patio_retirada="id_patio_saida",
        id_patio_entrega="id_patio_chegada_realizada",
        duracao_dias_prevista="duracao_dias_prevista",
        duracao_dias_real="duracao_dias_real",
        valor_total="valor_final",
        status_locacao="status_conformado",
    )
    return _with_reservation(laid, reservations, take)


def rentals_g2(s: Frames) -> DataFrame:
    return _rental(
        s["g2_locacao"],
        "G2",
        id_locacao_orig="id_locacao",
        data_retirada="data_retirada_real",
        data_devolucao="data_devolucao_real",
        id_cliente="cliente_id",
        id_veiculo="veiculo_id",
        id_patio_retirada="patio_retirada_id",
        id_patio_entrega="patio_devolucao_id",
        duracao_dias_prevista="duracao_dias_prevista",
        duracao_dias_real="duracao_dias_real",
        valor_diaria="valor_diaria_aplicada",
        valor_total=F.col("valor_diaria_aplicada") * F.col("duracao_dias_real"),
        km_percorridos="km_percorridos",
        status_locacao="status",
    )


def rentals_g3(s: Frames, clients: DataFrame | None = None) -> DataFrame:
    """Client, planned days and revenue come from the reservation."""
    reservations = s["g3_reserva"].select(
        "id_reserva", "id_cliente", F.col("duracao_prevista_dias").cast("int"), F.col("preco_final").cast(MONEY)
    )
    take = {"id_cliente": "id_cliente", "duracao_prevista_dias": "duracao_dias_prevista", "preco_final": "valor_total"}
    if clients is not None:
        reservations, take = _with_client(reservations, clients, "G3", "id_reserva"), take | CLIENT
    laid = _rental(
        s["g3_locacao"],
        "G3",
        ["id_reserva"],
        id_locacao_orig="id_locacao",
        data_retirada="data_locacao",
        data_devolucao="data_devolucao",
        id_veiculo="id_veiculo",
        id_patio_retirada="id_patio",
        id_patio_entrega="id_patio_entrega",
        duracao_dias_real="duracao_dias_real",
        status_locacao="status_conformado",
    )
    return _with_reservation(laid, reservations, take)


def rentals_g4(s: Frames) -> DataFrame:
    return _rental(
        s["g4_locacao"],
        "G4",
        id_locacao_orig="id_locacao",
        data_retirada="dt_retirada",
        data_devolucao="dt_chegada",
        id_cliente="id_motorista",
        id_veiculo="id_veiculo",
        id_patio_retirada="id_patio_retirada",
        id_patio_entrega="id_patio_entrega",
        duracao_dias_real="duracao_dias_real",
        valor_diaria="valor_diaria",
        valor_total=F.col("valor_diaria") * F.col("duracao_dias_real"),
        status_locacao="status_conformado",
    )


def rental_rows(s: Frames, clients: DataFrame | None = None) -> DataFrame:
    """Rentals of all sources, from conformed staging.

    With ``clients`` the rows have the key of their client. G1 and G3 know it
    from their reservations, which are fewer and narrower than the rentals to
    look it up for: should clients take a shuffle, half the rentals don't.
    """
    own = rentals_g2(s).unionByName(rentals_g4(s))
    if clients is not None:
        own = _source_key(own, clients, "id_cliente", "id_cliente_orig", CLIENT, "id_locacao_orig")
    return rentals_g1(s, clients).unionByName(own).unionByName(rentals_g3(s, clients))


def reservation_rows(s: Frames) -> DataFrame:
    """Reservations of G1, G2 and G3; G4's name no client, group or yard."""

    def row(table: str, tag: str, **cols: str | Column) -> DataFrame:
        return s[table].select(*(X.col(c).alias(n) for n, c in cols.items()), F.lit(tag).alias("fonte_grupo"))

    g1 = row(
        "g1_reserva",
        "G1",
        id_reserva_orig="id_reserva",
        data_solicitacao=F.col("data_hora_solicitacao").cast("date"),
        data_retirada=F.col("data_hora_retirada_prevista").cast("date"),
        data_devolucao=F.col("data_hora_devolucao_prevista").cast("date"),
        id_cliente="id_cliente",
        id_grupo="id_grupo",
        id_patio_retirada="id_patio_retirada",
        id_patio_devolucao=F.lit(None).cast("bigint"),
        duracao_prevista_dias=X.whole_days("data_hora_retirada_prevista", "data_hora_devolucao_prevista"),
        status_reserva="status_reserva",
    )
    g2 = row(
        "g2_reserva",
        "G2",
        id_reserva_orig="id_reserva",
        data_solicitacao=F.col("data_reserva").cast("date"),
        data_retirada=F.col("data_retirada_prevista").cast("date"),
        data_devolucao=F.col("data_devolucao_prevista").cast("date"),
        id_cliente="cliente_id",
        id_grupo="grupo_id",
        id_patio_retirada="patio_retirada_id",
        id_patio_devolucao="patio_devolucao_id",
        duracao_prevista_dias=X.whole_days("data_retirada_prevista", "data_devolucao_prevista"),
        status_reserva="estado",
    )
    g3 = row(
        "g3_reserva",
        "G3",
        id_reserva_orig="id_reserva",
        data_solicitacao="data_reserva",
        data_retirada=F.col("data_inicio_combinada").cast("date"),
        data_devolucao=F.col("data_fim_combinada").cast("date"),
        id_cliente="id_cliente",
        id_grupo="id_grupo",
        id_patio_retirada="id_patio_origem",
        id_patio_devolucao="id_patio_fim",
        duracao_prevista_dias="duracao_prevista_dias",
        status_reserva="status_conformado",
    )
    return g1.unionByName(g2).unionByName(g3)


def _date_key(df: DataFrame, dates: DataFrame, column: str, sk: str, spread_by: str) -> DataFrame:
    return lookup(df, dates, {column: "data_completa"}, {"sk_tempo": sk}, spread_nulls_by=[spread_by])


def _source_key(
    df: DataFrame, dim: DataFrame, column: str, key: str, take: Mapping[str, str], spread_by: str | None = None
) -> DataFrame:
    """Look ``column`` up within the row's own source; ids that are often NULL are spread by another column."""
    on = {"fonte_grupo": "fonte_grupo", column: key}
    return lookup(df, dim, on, take, spread_nulls_by=[spread_by] if spread_by else ())


def _reasons(**missing: Column) -> Column:
    """Names of the mandatory lookups that found nothing, sorted as declared."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in missing.items())))


def resolve_rentals(rows: DataFrame, dims: Frames) -> DataFrame:
    """Rental rows with every key looked up (the client's only if they don't have it) and ``motivos`` listing what is missing.

    Vehicles and clients grow with the rentals and come first: where they take a
    shuffle, the rows go through it without the keys of dates and yards.
    """
    row_id, dates, yards = "id_locacao_orig", dims["dim_tempo"], dims["dim_patio"]
    df = _source_key(
        rows, dims["dim_veiculo"], "id_veiculo", "id_veiculo_orig", {"sk_veiculo": "sk_veiculo", "sk_grupo": "sk_grupo"}
    )
    if "sk_cliente" not in rows.columns:
        df = _source_key(df, dims["dim_cliente"], "id_cliente", "id_cliente_orig", CLIENT, row_id)
    df = _date_key(df, dates, "data_retirada", "sk_tempo_retirada", row_id)
    df = _date_key(df, dates, "data_devolucao", "sk_tempo_devolucao", row_id)
    df = _source_key(df, yards, "id_patio_retirada", "id_patio_orig", {"sk_patio": "sk_patio_retirada"})
    df = _source_key(df, yards, "id_patio_entrega", "id_patio_orig", {"sk_patio": "sk_patio_entrega"}, row_id)
    df = lookup(df, dims["dim_grupo_veiculo"], {"sk_grupo": "sk_grupo"}, {"valor_diaria": "diaria_grupo"})
    # G1 and G3 charge the group's rate; G2 and G4 carry their own.
    rate = F.when(F.col("fonte_grupo").isin("G1", "G3"), F.col("diaria_grupo")).otherwise(F.col("valor_diaria"))
    return df.withColumn("valor_diaria", rate).withColumn(
        "motivos",
        _reasons(
            CLIENTE=F.col("sk_cliente").isNull(),
            DATA_RETIRADA=F.col("sk_tempo_retirada").isNull(),
            PATIO_RETIRADA=F.col("sk_patio_retirada").isNull(),
            VEICULO=F.col("sk_veiculo").isNull(),
        ),
    )


def resolve_reservations(rows: DataFrame, dims: Frames) -> DataFrame:
    """Reservation rows with every key looked up and ``motivos`` listing what is missing."""
    row_id, dates, yards = "id_reserva_orig", dims["dim_tempo"], dims["dim_patio"]
    df = _date_key(rows, dates, "data_solicitacao", "sk_tempo_solicitacao", row_id)
    df = _date_key(df, dates, "data_retirada", "sk_tempo_retirada_prev", row_id)
    df = _date_key(df, dates, "data_devolucao", "sk_tempo_devolucao_prev", row_id)
    df = _source_key(df, yards, "id_patio_retirada", "id_patio_orig", {"sk_patio": "sk_patio_retirada"})
    df = _source_key(df, yards, "id_patio_devolucao", "id_patio_orig", {"sk_patio": "sk_patio_devolucao"}, row_id)
    df = _source_key(df, dims["dim_grupo_veiculo"], "id_grupo", "id_grupo_orig", {"sk_grupo": "sk_grupo"})
    df = _source_key(df, dims["dim_cliente"], "id_cliente", "id_cliente_orig", CLIENT)
    return df.withColumn(
        "motivos",
        _reasons(
            CLIENTE=F.col("sk_cliente").isNull(),
            DATA_DEVOLUCAO=F.col("sk_tempo_devolucao_prev").isNull(),
            DATA_RETIRADA=F.col("sk_tempo_retirada_prev").isNull(),
            DATA_SOLICITACAO=F.col("sk_tempo_solicitacao").isNull(),
            GRUPO=F.col("sk_grupo").isNull(),
            PATIO_RETIRADA=F.col("sk_patio_retirada").isNull(),
        ),
    )


def accepted(resolved: DataFrame, table: str) -> DataFrame:
    """The fact rows, in their declared columns."""
    return conform_to(resolved.where(F.size("motivos") == 0), star_schema(table))


def rejected(resolved: DataFrame, id_column: str) -> DataFrame:
    """What the load leaves out, and why: one row per rejected row."""
    return resolved.where(F.size("motivos") > 0).select("fonte_grupo", id_column, "motivos")
