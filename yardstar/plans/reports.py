"""Management reports A to D over the star tables.

Every report first aggregates its fact by surrogate keys and joins the
dimensions to that small result. The partial sums combine before any shuffle,
so one client, yard or day holding a large share of the rows does not matter.
Counts and sums of whole numbers and decimals stay exact; averages divide once,
at the end. Orders use the warehouse database's rule: NULLs last ascending,
first descending.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions.lookups import lookup

Star = Mapping[str, DataFrame]


def _group(df: DataFrame, star: Star, **take: str) -> DataFrame:
    return lookup(df, star["dim_grupo_veiculo"], {"sk_grupo": "sk_grupo"}, {c: n for n, c in take.items()}, "inner")


def _yard(df: DataFrame, star: Star, key: str, **take: str) -> DataFrame:
    return lookup(df, star["dim_patio"], {key: "sk_patio"}, {c: n for n, c in take.items()}, "inner")


def _client(df: DataFrame, star: Star, **take: str) -> DataFrame:
    return lookup(df, star["dim_cliente"], {"sk_cliente": "sk_cliente"}, {c: n for n, c in take.items()}, "inner")


def _date(df: DataFrame, star: Star, key: str, where: Column | None = None, **take: str) -> DataFrame:
    dates = star["dim_tempo"] if where is None else star["dim_tempo"].where(where)
    return lookup(df, dates, {key: "sk_tempo"}, {c: n for n, c in take.items()}, "inner")


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _mean(total: str, n: str) -> Column:
    """Average from a sum and a count; NULL for no values."""
    return F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0))


def report_a_yard_control(star: Star) -> DataFrame:
    """Vehicles by yard, owner, group, class, origin and day."""
    df = (
        star["fato_patio_snapshot"]
        .groupBy("sk_tempo", "sk_patio", "sk_grupo", "origem_veiculo")
        .agg(F.count("*").alias("n"))
    )
    df = _date(df, star, "sk_tempo", data_snapshot="data_completa")
    df = _yard(df, star, "sk_patio", patio="nome_patio", empresa_dona_patio="empresa_dona")
    df = _group(df, star, grupo_veiculo="nome_grupo", classe_luxo="classe_luxo")
    return (
        df.groupBy(
            "patio",
            "empresa_dona_patio",
            "grupo_veiculo",
            "classe_luxo",
            F.col("origem_veiculo").alias("origem"),
            "data_snapshot",
        )
        .agg(F.sum("n").alias("total_veiculos"))
        .orderBy(*_asc("patio", "grupo_veiculo", "origem"))
    )


def report_a_latest(star: Star) -> DataFrame:
    """Report A of the newest day that has a snapshot.

    The snapshot is partitioned by day, so only that day's files are read.
    """
    days = star["fato_patio_snapshot"].select("sk_tempo").distinct()
    newest = _date(days, star, "sk_tempo", data="data_completa").select(F.max_by("sk_tempo", "data"))
    latest = star["fato_patio_snapshot"].where(F.col("sk_tempo") == newest.scalar())
    return report_a_yard_control({**star, "fato_patio_snapshot": latest})


def report_b_rental_control(star: Star, as_of: date | None = None) -> DataFrame:
    """Rentals by group, class and status, with durations, days left and revenue."""
    active = F.col("status_locacao") == C.ACTIVE
    planned = F.when(active, F.col("duracao_dias_prevista"))
    df = (
        star["fato_locacao"]
        .groupBy("sk_grupo", "status_locacao", "sk_tempo_retirada")
        .agg(
            F.count("*").alias("n"),
            F.sum("duracao_dias_real").alias("dias"),
            F.count("duracao_dias_real").alias("n_dias"),
            F.max("duracao_dias_real").alias("maior"),
            F.min("duracao_dias_real").alias("menor"),
            F.sum(planned).alias("previstos"),
            F.count(planned).alias("n_previstos"),
            F.sum(F.coalesce("valor_total", F.lit(0).cast("decimal(10,2)"))).alias("receita"),
        )
    )
    df = _date(df, star, "sk_tempo_retirada", data="data_completa")
    # Days left = planned - (as_of - pickup), summed over the rentals of the day.
    elapsed = F.datediff(C.as_of_column(as_of), "data") * F.col("n_previstos")
    df = df.withColumn("restantes", F.col("previstos") - elapsed)
    df = _group(df, star, grupo_veiculo="nome_grupo", classe_luxo="classe_luxo")
    total = df.groupBy("grupo_veiculo", "classe_luxo", F.col("status_locacao").alias("status")).agg(
        F.sum("n").alias("total_locacoes"),
        F.sum("dias").alias("dias"),
        F.sum("n_dias").alias("n_dias"),
        F.max("maior").alias("max_dias"),
        F.min("menor").alias("min_dias"),
        F.sum("restantes").alias("restantes"),
        F.sum("n_previstos").alias("n_previstos"),
        F.sum("receita").cast("decimal(38,2)").alias("receita_total"),
    )
    return total.select(
        "grupo_veiculo",
        "classe_luxo",
        "status",
        "total_locacoes",
        _mean("dias", "n_dias").alias("media_dias_duracao"),
        "max_dias",
        "min_dias",
        _mean("restantes", "n_previstos").alias("media_dias_restantes"),
        "receita_total",
    ).orderBy(*_asc("grupo_veiculo", "status"))


def _finished(star: Star) -> DataFrame:
    return star["fato_locacao"].where(F.col("status_locacao") == C.DONE)


def report_b_monthly(star: Star) -> DataFrame:
    """Finished rentals by month of pickup and group."""
    df = (
        _finished(star)
        .groupBy("sk_tempo_retirada", "sk_grupo")
        .agg(
            F.count("*").alias("n"),
            F.sum("duracao_dias_real").alias("dias"),
            F.sum("valor_total").alias("receita"),
        )
    )
    df = _date(df, star, "sk_tempo_retirada", ano="ano", mes="mes", nome_mes="nome_mes")
    df = _group(df, star, nome_grupo="nome_grupo")
    return (
        df.groupBy("ano", "mes", "nome_mes", "nome_grupo")
        .agg(
            F.sum("n").alias("total_locacoes"),
            F.sum("dias").alias("total_dias_locados"),
            F.sum("receita").cast("decimal(38,2)").alias("receita_mes"),
        )
        .orderBy(*_asc("ano", "mes", "nome_grupo"))
    )


def report_c_reservations(star: Star) -> DataFrame:
    """Reservations by group, yard, client city, planned month and status."""
    keys = ["sk_grupo", "sk_patio_retirada", "status_reserva"]
    # A client has few reservations: counting pays only by city.
    df = _client(
        star["fato_reserva"].select(*keys, "sk_cliente", "sk_tempo_retirada_prev", "duracao_prevista_dias"),
        star,
        cidade_cliente="cidade_origem",
        uf_cliente="uf_origem",
    )
    df = df.groupBy(*keys, "cidade_cliente", "uf_cliente", "sk_tempo_retirada_prev").agg(
        F.count("*").alias("n"),
        F.sum("duracao_prevista_dias").alias("dias"),
        F.count("duracao_prevista_dias").alias("n_dias"),
    )
    month = ["ano_retirada_prevista", "mes_retirada_prevista", "nome_mes_retirada"]
    df = _date(
        df,
        star,
        "sk_tempo_retirada_prev",
        ano_retirada_prevista="ano",
        mes_retirada_prevista="mes",
        nome_mes_retirada="nome_mes",
    )
    df = _group(df, star, grupo_veiculo="nome_grupo")
    df = _yard(df, star, "sk_patio_retirada", patio_retirada="nome_patio")
    by = ["grupo_veiculo", "patio_retirada", "cidade_cliente", "uf_cliente", *month]
    total = df.groupBy(*by, F.col("status_reserva").alias("status")).agg(
        F.sum("n").alias("total_reservas"), F.sum("dias").alias("dias"), F.sum("n_dias").alias("n_dias")
    )
    return total.select(
        *by, "status", "total_reservas", _mean("dias", "n_dias").alias("media_duracao_prevista")
    ).orderBy(*_asc("ano_retirada_prevista", "mes_retirada_prevista", "grupo_veiculo", "patio_retirada"))


def report_c_next_week(star: Star, as_of: date | None = None) -> DataFrame:
    """Reservations to be picked up from ``as_of`` to seven days later, both included."""
    first = C.as_of_column(as_of)
    last = F.date_add(first, 7)
    due = star["fato_reserva"].where(F.col("status_reserva") != C.CANCELLED)
    if "periodo_retirada" in due.columns:
        # The week lies in at most two partitions, whether they are months or years.
        periods = [F.trunc(d, grain) for d in (first, last) for grain in ("month", "year")]
        due = due.where(F.col("periodo_retirada").isin(*periods))
    df = _date(due, star, "sk_tempo_retirada_prev", F.col("data_completa").between(first, last), data="data_completa")
    df = df.groupBy("sk_grupo", "sk_patio_retirada", "sk_cliente").agg(F.count("*").alias("n"))
    df = _client(df, star, cidade_origem="cidade_origem")
    df = _group(df, star, nome_grupo="nome_grupo")
    df = _yard(df, star, "sk_patio_retirada", nome_patio="nome_patio")
    return (
        df.groupBy("nome_grupo", "nome_patio", "cidade_origem")
        .agg(F.sum("n").alias("reservas_proxima_semana"))
        .orderBy(
            F.col("reservas_proxima_semana").desc_nulls_first(), *_asc("nome_grupo", "nome_patio", "cidade_origem")
        )
    )


def report_d_group_by_city(star: Star) -> DataFrame:
    """Finished rentals by client city and group, most rented first."""
    df = (
        _finished(star)
        .groupBy("sk_cliente", "sk_grupo")
        .agg(
            F.count("*").alias("n"),
            F.sum("duracao_dias_real").alias("dias"),
            F.sum("valor_total").alias("receita"),
            F.count("valor_total").alias("n_receita"),
        )
    )
    df = _client(df, star, cidade_cliente="cidade_origem", uf_cliente="uf_origem")
    df = _group(df, star, grupo_veiculo="nome_grupo", classe_luxo="classe_luxo")
    keys = ["cidade_cliente", "uf_cliente", "grupo_veiculo", "classe_luxo"]
    total = df.groupBy(*keys).agg(
        F.sum("n").alias("total_locacoes"),
        F.sum("dias").alias("total_dias_locados"),
        F.sum("receita").cast("decimal(38,2)").alias("receita_total"),
        F.sum("n_receita").alias("n_receita"),
    )
    ticket = F.round(F.col("receita_total").cast("decimal(30,2)") / F.nullif(F.col("n_receita"), F.lit(0)), 2)
    return total.select(
        *keys,
        "total_locacoes",
        "total_dias_locados",
        "receita_total",
        ticket.cast("decimal(28,2)").alias("ticket_medio"),
    ).orderBy(F.col("total_locacoes").desc_nulls_first(), *_asc(*keys))


def report_d_top10(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` most rented city and group pairs; ties go by city, state, group and class."""
    return report_d_group_by_city(star).limit(n)


def report_d_group_ranking(star: Star) -> DataFrame:
    """Finished rentals and revenue by group over all cities."""
    df = _finished(star).groupBy("sk_grupo").agg(F.count("*").alias("n"), F.sum("valor_total").alias("receita"))
    df = _group(df, star, nome_grupo="nome_grupo", classe_luxo="classe_luxo")
    return (
        df.groupBy("nome_grupo", "classe_luxo")
        .agg(F.sum("n").alias("total_locacoes"), F.sum("receita").cast("decimal(38,2)").alias("receita_total"))
        .orderBy(F.col("total_locacoes").desc_nulls_first(), *_asc("nome_grupo", "classe_luxo"))
    )


def rental_count(star: Star) -> DataFrame:
    return star["fato_locacao"].agg(F.count("*").alias("total"))


def clients_of_source(star: Star, source: str) -> DataFrame:
    return star["dim_cliente"].where(F.col("fonte_grupo") == source)
