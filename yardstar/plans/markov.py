"""Yard occupancy forecast: a Markov chain over yard-to-yard movements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar import config as C
from yardstar.functions.lookups import lookup
from yardstar.session import checkpoint_ready

Star = Mapping[str, DataFrame]

SHARE = "decimal(24,18)"


def transition_counts(star: Star) -> DataFrame:
    """Finished rentals by pickup and return yard name.

    The fact is counted by yard keys first; names are joined to that.
    """
    pairs = (
        star["fato_locacao"]
        .where((F.col("status_locacao") == C.DONE) & F.col("sk_patio_entrega").isNotNull())
        .groupBy("sk_patio_retirada", "sk_patio_entrega")
        .agg(F.count("*").alias("n"))
    )
    df = lookup(pairs, star["dim_patio"], {"sk_patio_retirada": "sk_patio"}, {"nome_patio": "patio_origem"}, "inner")
    df = lookup(df, star["dim_patio"], {"sk_patio_entrega": "sk_patio"}, {"nome_patio": "patio_destino"}, "inner")
    return df.groupBy("patio_origem", "patio_destino").agg(F.sum("n").alias("total_transicoes"))


def departures(counts: DataFrame) -> DataFrame:
    """Departures per pickup yard, from the counts: every return yard key has a name."""
    return counts.groupBy("patio_origem").agg(F.sum("total_transicoes").alias("total_saidas"))


def transition_matrix(counts: DataFrame) -> DataFrame:
    """Share of each destination per origin: percent to 2 places, probability to 4."""
    df = lookup(counts, departures(counts), {"patio_origem": "patio_origem"}, {"total_saidas": "total_saidas"}, "inner")
    share = F.col("total_transicoes").cast("decimal(20,0)") / F.nullif(
        F.col("total_saidas").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
    )
    return df.select(
        "patio_origem",
        "patio_destino",
        "total_transicoes",
        "total_saidas",
        F.round(share * 100, 2).cast("decimal(7,2)").alias("percentual"),
        F.round(share, 4).cast("decimal(7,4)").alias("probabilidade"),
    )


def yard_names(star: Star) -> list[str]:
    """All distinct yard names in order; they become the pivot's columns, so the plan is as wide as they are many."""
    return [r[0] for r in star["dim_patio"].select("nome_patio").distinct().orderBy("nome_patio").collect()]


def pivot_matrix(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per origin, one column per destination; NULL where nothing moved."""
    return matrix.groupBy("patio_origem").pivot("patio_destino", list(names)).agg(F.first("probabilidade"))


def row_check(matrix: DataFrame, tol: float = 0.001) -> DataFrame:
    """Does every row add up to one, within ``tol``? Rounded entries can miss it by their number."""
    total = F.sum("probabilidade")
    ok = F.abs(total - F.lit(1)) < F.lit(str(tol)).cast("decimal(18,9)")
    return matrix.groupBy("patio_origem").agg(
        F.round(total, 4).cast("decimal(12,4)").alias("soma_probabilidades"),
        F.when(ok, C.ROW_SUM_OK).otherwise(C.ROW_SUM_BAD).alias("validacao"),
    )


def _step(vector: DataFrame, matrix: DataFrame) -> DataFrame:
    v = vector.select(F.col("patio").alias("__patio"), F.col("prob").alias("__prob"))
    return (
        matrix.join(v, matrix["patio_origem"] == v["__patio"])
        .groupBy(F.col("patio_destino").alias("patio"))
        .agg(F.sum(F.col("__prob") * F.col("probabilidade")).cast(SHARE).alias("prob"))
    )


def steady_state(
    matrix: DataFrame,
    yards: DataFrame,
    steps: int = 10,
    tol: float | None = None,
    max_steps: int = 1000,
    check_every: int = 10,
) -> DataFrame:
    """Expected share of vehicles per yard after ``steps`` moves from a uniform start.

    With ``tol`` it goes on until no share changes by more than that, or until
    ``max_steps``: the column ``convergiu`` tells which. A periodic chain never
    converges. Shares are decimals, so the result does not depend on the order of summation. A
    yard without departures leaks its share; one without arrivals drops out.

    The matrix (at most yards squared) is checkpointed once, so the fact is not
    read per step; with ``tol`` so is the vector, every ``check_every`` steps,
    and only the largest change comes to the driver.
    """
    checkpoint_ready(matrix.sparkSession)
    m = matrix.select("patio_origem", "patio_destino", "probabilidade").checkpoint()
    names = yards.select(F.col("nome_patio").alias("patio")).distinct()
    n = names.count()
    start = (F.lit(1).cast("decimal(20,0)") / F.lit(max(n, 1)).cast("decimal(20,0)")).cast(SHARE)
    vector = names.withColumn("prob", start)
    if tol is None:
        for _ in range(steps):
            vector = _step(vector, m)
    else:
        done, converged = 0, False
        while done < max_steps and not converged:
            several = min(check_every, max_steps - done)
            for _ in range(several - 1):
                vector = _step(vector, m)
            before = vector.checkpoint()
            vector = _step(before, m).checkpoint()
            done += several
            old = before.select("patio", F.col("prob").alias("__old"))
            change = vector.join(old, "patio", "full").agg(
                F.max(F.abs(F.coalesce("prob", F.lit(0)) - F.coalesce("__old", F.lit(0))))
            )
            converged = (change.first()[0] or 0) <= tol
    shares = ["patio", F.round(F.col("prob") * 100, 2).cast("decimal(10,2)").alias("percentual_equilibrio")]
    if tol is not None:
        shares.append(F.lit(converged).alias("convergiu"))
    return vector.select(*shares).orderBy(F.col("percentual_equilibrio").desc_nulls_first(), F.col("patio").asc_nulls_last())
