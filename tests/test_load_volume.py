"""What a load shuffles and writes: no more than its queries need."""

import os
import re
from datetime import datetime
from pathlib import Path

import pytest
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from yardstar.functions.lookups import lookup
from yardstar.operators import facts
from yardstar.operators.conform import conform
from yardstar.schemas import STAGING_DDL
from yardstar.sources import testbed as beds


@pytest.fixture
def folder(tmp_path):
    """The test tables under a path that no query has read yet."""
    for table in Path(SF).iterdir():
        os.symlink(table, tmp_path / table.name)
    return str(tmp_path)


@pytest.mark.parametrize("name", ["dim_yard", "yard_snapshot", "fact_reservation"])
def test_dimensions_come_without_rentals_and_facts(spark, folder, name):
    bed = beds.testbed(spark, folder)
    assert entry.queries()[name](spark, folder).count() > 0
    written = os.listdir(bed.root)
    assert "rentals" not in written  # line items aren't joined for it
    assert not [p for p in Path(bed.root).glob("dw/*/fato_*")]


def test_rentals_need_the_dimensions_only_and_the_facts_follow(spark, folder):
    bed, queries = beds.testbed(spark, folder), entry.queries()
    rentals = queries["fact_rental"](spark, folder)
    assert not [p for p in Path(bed.root).glob("dw/*/fato_*")]
    assert bed.warehouse.version == bed.dimensions.version
    columns = [c for c in rentals.columns if not c.startswith("sk_locacao")]
    stored = bed.warehouse["fato_locacao"].select(*columns)
    assert rentals.select(*columns).exceptAll(stored).isEmpty() and stored.exceptAll(rentals.select(*columns)).isEmpty()


def test_rentals_are_shuffled_without_the_keys_of_dates_and_yards(spark):
    """Vehicles too many to broadcast, all else small: the rows go through the one shuffle without what comes after."""
    kinds = T.StructType.fromDDL(facts.ROW_DDL["fato_locacao"])
    rows = spark.createDataFrame([], kinds)
    one = spark.range(1)
    source = F.lit("G1").alias("fonte_grupo")
    dims = {
        "dim_tempo": F.broadcast(one.select(F.lit("2000-01-01").cast("date").alias("data_completa"), F.col("id").alias("sk_tempo"))),
        "dim_patio": F.broadcast(one.select(source, F.col("id").alias("id_patio_orig"), F.col("id").alias("sk_patio"))),
        "dim_cliente": F.broadcast(one.select(source, F.col("id").alias("id_cliente_orig"), F.col("id").alias("sk_cliente"))),
        "dim_grupo_veiculo": F.broadcast(one.select(F.col("id").alias("sk_grupo"), F.lit(1).cast("decimal(10,2)").alias("valor_diaria"))),
        "dim_veiculo": one.select(source, F.col("id").alias("id_veiculo_orig"), F.col("id").alias("sk_veiculo"), F.col("id").alias("sk_grupo")).hint("merge"),
    }
    plan = facts.resolve_rentals(rows, dims)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if re.search(r"\bJoin LeftOuter", line)]
    assert len(joins) == 7
    # The plan lists the last join first: the merge with the vehicles is the deepest.
    assert "strategy=merge" in joins[-1] and not [j for j in joins[:-1] if "strategy=merge" in j]


def test_rentals_with_a_reservation_are_not_shuffled_for_their_client(spark):
    """Clients too many to broadcast: G1 and G3 look them up in their reservations, as G2 and G4 do in their rentals."""
    frames = {t: spark.createDataFrame([], ddl) for t, ddl in STAGING_DDL.items()}
    conformed = conform(frames)
    kind = "fonte_grupo STRING, id_cliente_orig BIGINT, sk_cliente BIGINT"
    clients = spark.createDataFrame([], kind).hint("merge")
    rows = facts.rental_rows(conformed, clients)
    plan = rows._jdf.queryExecution().analyzed().toString().splitlines()
    under = [k for k, line in enumerate(plan) if re.search(r"LogicalRDD \[fonte_grupo#\d+, id_cliente_orig", line)]
    assert len(under) == 3  # of G1's and G3's reservations, and of the rentals of G2 and G4
    names = T.StructType.fromDDL(facts.ROW_DDL["fato_locacao"]).names
    assert rows.columns == [*names, "sk_cliente"]
    assert facts.rental_rows(conformed).columns == names


def test_the_key_of_a_client_is_the_same_with_the_rentals_as_without(spark):
    """Doubled clients and reservations, walk-ins and unknown ids."""
    frames = {t: spark.createDataFrame([], ddl) for t, ddl in STAGING_DDL.items()}

    def fill(table, *rows):
        kinds = T.StructType.fromDDL(STAGING_DDL[table])
        frames[table] = spark.createDataFrame([tuple(r.get(n) for n in kinds.names) for r in rows], kinds)

    day = datetime(2000, 1, 1)
    fill("g1_reserva", *({"id_reserva": r, "id_cliente": c} for r, c in ((1, 9), (1, 7), (2, None), (3, 8), (None, 7))))
    fill("g1_locacao", *({"id_locacao": i, "id_reserva": r, "data_hora_retirada": day} for i, r in enumerate((1, 1, 2, 3, 4, None))))
    fill("g2_locacao", *({"id_locacao": i, "cliente_id": c} for i, c in enumerate((7, 8, None, 99))))
    fill("g3_reserva", *({"id_reserva": r, "id_cliente": c} for r, c in ((1, 9), (1, 7), (2, None), (None, 7))))
    fill("g3_locacao", *({"id_locacao": i, "id_reserva": r, "data_locacao": day} for i, r in enumerate((1, 2, 3, None))))
    fill("g4_locacao", *({"id_locacao": i, "id_motorista": c} for i, c in enumerate((7, None, 99))))
    found = [(f"G{g}", c, 100 * g + c) for g in (1, 2, 3, 4) for c in (7, 9)] + [("G1", 7, 107), ("G3", 9, 309), ("G1", None, 1)]
    clients = spark.createDataFrame(found, "fonte_grupo STRING, id_cliente_orig BIGINT, sk_cliente BIGINT")
    conformed = conform(frames)
    early = facts.rental_rows(conformed, clients)
    key = {"fonte_grupo": "fonte_grupo", "id_cliente": "id_cliente_orig"}
    late = lookup(facts.rental_rows(conformed), clients, key, {"sk_cliente": "sk_cliente"})
    rows = sorted(map(tuple, early.collect()), key=str)
    assert rows == sorted(map(tuple, late.collect()), key=str) and len(rows) == 21
