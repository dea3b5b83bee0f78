"""Where the vehicles of G3 and G4 stand: the yard of the last return at or before a day.

Neither source names a vehicle's home, but both record returns. The inventory is
an as-of join of days to movements that never has a row for each vehicle and
day: movements are reduced to the last of each vehicle between two days, these
become stays, stays become +1 and -1 of their yard, and a running sum over days
counts the vehicles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar.operators.availability import running_sum

Frames = Mapping[str, DataFrame]

# The columns of the two sources' rentals.
RENTALS = {
    "G3": ("g3_locacao", "data_locacao", "data_devolucao"),
    "G4": ("g4_locacao", "dt_retirada", "dt_chegada"),
}


def movements(s: Frames) -> DataFrame:
    """``(fonte_grupo, id_veiculo, quando, volta, id_patio)`` from conformed rentals: returns, and pickups as no yard.

    Rows without vehicle or time are left out. A return without a known yard
    leaves the vehicle nowhere known, as a pickup does.
    """
    parts = []
    for source, (table, pickup, back) in RENTALS.items():
        own = [F.lit(source).alias("fonte_grupo"), F.col("id_veiculo").cast("long").alias("id_veiculo")]
        nowhere = F.lit(None).cast("long").alias("id_patio")
        yard = F.col("id_patio_entrega").cast("long").alias("id_patio")
        parts.append(s[table].select(*own, F.col(pickup).alias("quando"), F.lit(0).alias("volta"), nowhere))
        parts.append(s[table].select(*own, F.col(back).alias("quando"), F.lit(1).alias("volta"), yard))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.where("id_veiculo IS NOT NULL AND quando IS NOT NULL")


def yard_inventory(s: Frames, yards: DataFrame, days: Sequence[date]) -> DataFrame:
    """``(fonte_grupo, id_patio, dia, veiculos)``: vehicles of G3 and G4 in each yard at the end of each day asked for.

    ``yards`` has ``fonte_grupo, id_patio``; every yard has a row for every
    day. A vehicle stands where its last movement up to the end of the day
    left it; of movements of one moment returns come after pickups, then the
    higher yard counts. Vehicles that are out or were never returned are
    nowhere; returns to a yard that is not among ``yards`` are not counted.
    """
    asked = sorted(set(days))
    listed = F.array(*(F.lit(d).cast("date") for d in asked))
    # The first day asked for that sees the movement.
    at = F.size(F.filter(listed, lambda d: d < F.col("quando").cast("date")))
    last = (
        movements(s)
        .withColumn("n", at)
        .where(F.col("n") < len(asked))
        .groupBy("fonte_grupo", "id_veiculo", "n")
        .agg(F.max_by(F.struct("id_patio"), F.struct("quando", "volta", "id_patio")).alias("m"))
        .select("fonte_grupo", "id_veiculo", "n", "m.id_patio")
    )
    # At most as many entries a vehicle as there are days.
    line = last.groupBy("fonte_grupo", "id_veiculo").agg(F.sort_array(F.collect_list(F.struct("n", "id_patio"))).alias("m"))
    stay = F.transform(
        "m", lambda x, i: F.struct(x["n"].alias("n"), x["id_patio"].alias("id_patio"), F.get("m", i + 1)["n"].alias("ate"))
    )
    stays = line.select("fonte_grupo", F.explode(stay).alias("s")).select("fonte_grupo", "s.*").where("id_patio IS NOT NULL")
    changes = stays.select(
        "fonte_grupo",
        "id_patio",
        F.explode(
            F.array(
                F.struct(F.col("n").alias("n"), F.lit(1).cast("long").alias("mais")),
                F.struct(F.col("ate").alias("n"), F.lit(-1).cast("long").alias("mais")),
            )
        ).alias("e"),
    ).select("fonte_grupo", "id_patio", "e.*").where("n IS NOT NULL")
    changes = changes.groupBy("fonte_grupo", "id_patio", "n").agg(F.sum("mais").alias("mais"))
    known = yards.select("fonte_grupo", F.col("id_patio").cast("long").alias("id_patio")).where(F.col("fonte_grupo").isin(*RENTALS))
    every = known.distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(len(asked) - 1))).alias("n"))
    daily = every.join(changes, ["fonte_grupo", "id_patio", "n"], "left").select(
        "fonte_grupo", "id_patio", "n", F.coalesce("mais", F.lit(0)).alias("mais")
    )
    counted = running_sum(daily, ["fonte_grupo", "id_patio"], "n", "mais")
    return counted.select("fonte_grupo", "id_patio", F.get(listed, F.col("n")).alias("dia"), F.col("total").alias("veiculos"))
