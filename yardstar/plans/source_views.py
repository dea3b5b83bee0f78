"""The five views of source G2 over its own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions.lookups import lookup


def vehicles_by_yard(vehicles: DataFrame, groups: DataFrame, yards: DataFrame) -> DataFrame:
    """Available vehicles by home yard and group code."""
    df = (
        vehicles.where(F.col("situacao") == C.G2_AVAILABLE)
        .groupBy("grupo_id", "patio_origem_id")
        .agg(F.count("*").alias("n"))
    )
    df = lookup(df, groups, {"grupo_id": "id_grupo"}, {"codigo": "grupo"}, "inner")
    df = lookup(df, yards, {"patio_origem_id": "id_patio"}, {"nome": "patio"}, "inner")
    return df.groupBy("patio", "grupo").agg(F.sum("n").alias("total"))


def active_rentals(rentals: DataFrame, vehicles: DataFrame, groups: DataFrame) -> DataFrame:
    """Rentals in progress by group code."""
    df = rentals.where(F.col("status") == C.ACTIVE).groupBy("veiculo_id").agg(F.count("*").alias("n"))
    df = lookup(df, vehicles, {"veiculo_id": "id_veiculo"}, {"grupo_id": "grupo_id"}, "inner")
    df = lookup(df, groups, {"grupo_id": "id_grupo"}, {"codigo": "grupo"}, "inner")
    return df.groupBy("grupo").agg(F.sum("n").alias("total_locacoes"))


def open_reservations(
    reservations: DataFrame, groups: DataFrame, yards: DataFrame, clients: DataFrame
) -> DataFrame:
    """Confirmed and waiting reservations by group code, pickup yard and client city."""
    # A client has few reservations: counting pays only by city.
    df = reservations.where(F.col("estado").isin(C.CONFIRMED, "EM_FILA_ESPERA"))
    df = lookup(df, clients, {"cliente_id": "id_cliente"}, {"cidade_origem": "cidade_origem"}, "inner")
    df = df.groupBy("grupo_id", "patio_retirada_id", "cidade_origem").agg(F.count("*").alias("n"))
    df = lookup(df, groups, {"grupo_id": "id_grupo"}, {"codigo": "grupo"}, "inner")
    df = lookup(df, yards, {"patio_retirada_id": "id_patio"}, {"nome": "patio_retirada"}, "inner")
    return df.groupBy("grupo", "patio_retirada", "cidade_origem").agg(F.sum("n").alias("total"))


def groups_by_city(rentals: DataFrame, clients: DataFrame, vehicles: DataFrame, groups: DataFrame) -> DataFrame:
    """All rentals by client city and group code, most first."""
    # Client and vehicle are nearly unique together: counting pays only by city and group.
    df = lookup(rentals, vehicles, {"veiculo_id": "id_veiculo"}, {"grupo_id": "grupo_id"}, "inner")
    df = lookup(df, clients, {"cliente_id": "id_cliente"}, {"cidade_origem": "cidade_origem"}, "inner")
    df = df.groupBy("cidade_origem", "grupo_id").agg(F.count("*").alias("n"))
    df = lookup(df, groups, {"grupo_id": "id_grupo"}, {"codigo": "grupo"}, "inner")
    return (
        df.groupBy("cidade_origem", "grupo")
        .agg(F.sum("n").alias("total_locacoes"))
        .orderBy(F.col("total_locacoes").desc(), F.col("cidade_origem").asc_nulls_last(), "grupo")
    )


def yard_movements(rentals: DataFrame, yards: DataFrame) -> DataFrame:
    """Finished rentals by pickup and return yard."""
    df = (
        rentals.where(F.col("status") == C.DONE)
        .groupBy("patio_retirada_id", "patio_devolucao_id")
        .agg(F.count("*").alias("n"))
    )
    df = lookup(df, yards, {"patio_retirada_id": "id_patio"}, {"nome": "patio_retirada"}, "inner")
    df = lookup(df, yards, {"patio_devolucao_id": "id_patio"}, {"nome": "patio_devolucao"}, "inner")
    return df.groupBy("patio_retirada", "patio_devolucao").agg(F.sum("n").alias("total_locacoes"))
