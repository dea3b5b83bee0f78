"""Availability, the waiting queue and the yard inventory against brute force, with odd rows."""

import contextlib
import io
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from yardstar.operators.availability import fleet_availability, running_sum, waiting_queue
from yardstar.operators.inventory import yard_inventory

D0 = date(2026, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def test_running_sum_over_ranges(spark):
    rng = random.Random(1)
    rows = [(k, at, rng.randrange(-5, 9)) for k in "ab" for at in rng.sample(range(-400, 400), 150)]
    got = running_sum(spark.createDataFrame(rows, "k string, at int, n int"), ["k"], "at", "n", width=16).collect()
    for r in got:
        assert r.total == sum(n for k, at, n in rows if k == r.k and at <= r.at)
    assert len(got) == len(rows)


def test_availability(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a = rng.randrange(-30, 60)
        rows.append((rng.choice("GH"), rng.choice([1, 2, 9, None]), day(a), rng.choice([None, day(a + rng.randrange(0, 20)), day(a - 1)])))
    rows += [("G", 1, None, day(3))] + [("G", 1, day(5), day(5))] * 50
    fleet = [("G", 1, 30), ("G", 2, 4), ("H", 1, 0), ("H", 7, 3)]
    got = fleet_availability(
        spark.createDataFrame(rows, "fonte_grupo string, id_grupo long, retirada date, devolucao date"),
        spark.createDataFrame(fleet, "fonte_grupo string, id_grupo long, frota long"),
        F.lit(D0),
        F.lit(day(40)),
    ).collect()
    assert len(got) == len(fleet) * 41
    for r in got:
        out = sum(
            f == r.fonte_grupo and g == r.id_grupo and a is not None and a <= r.dia and (b is None or (b >= a and b >= r.dia))
            for f, g, a, b in rows
        )
        free = dict(((f, g), n) for f, g, n in fleet)[r.fonte_grupo, r.id_grupo] - out
        assert (r.reservados, r.livres) == (out, free), r


def test_a_hot_group_is_counted_before_it_is_shuffled(spark):
    held = spark.range(10_000).select(
        F.lit("G").alias("fonte_grupo"), F.lit(1).cast("long").alias("id_grupo"), F.lit(D0).alias("retirada"), F.lit(D0).alias("devolucao")
    )
    fleet = spark.createDataFrame([("G", 1, 5)], "fonte_grupo string, id_grupo long, frota long")
    df = fleet_availability(held, fleet, F.lit(D0), F.lit(day(1)))
    assert [(r.dia, r.livres) for r in df.orderBy("dia").collect()] == [(D0, -9_995), (day(1), 5)]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    assert "partial_sum" in text.getvalue() and "NestedLoop" not in text.getvalue()


def brute_queue(rows, slots):
    out, free = [], {}
    lines = defaultdict(list)
    for row in rows:
        lines[row[:2]].append(row)
    for key, its in lines.items():
        free = [None] * (0 if None in key else slots.get(key, 0))
        order = [(r[3] is not None, r[3] or 0, r[2] is not None, r[2] or 0, r[4] is not None, r[4] or 0) for r in its]
        for place, (_, r) in enumerate(sorted(zip(order, its, strict=True), key=lambda x: x[0]), 1):
            vaga = None
            if r[3] and r[4] and r[5] and r[5] >= r[4] and free:
                first = min(range(len(free)), key=lambda i: (free[i] is not None, free[i] or 0, i))
                if free[first] is None or free[first] <= r[4]:
                    free[first], vaga = r[5], first + 1
            out.append((*key, r[2], place, vaga))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_waiting_queue(spark, seed):
    rng = random.Random(seed)
    t0 = datetime(2026, 1, 1)
    rows = []
    for i in range(500):
        asked = t0 + timedelta(hours=rng.randrange(300))
        begins = asked + timedelta(hours=rng.randrange(200))
        ends = begins + timedelta(hours=rng.randrange(-2, 90))
        row = [rng.choice([1, 1, 1, 2, None]), rng.choice([1, 2]), i if rng.random() < 0.98 else None, asked, begins, ends]
        if rng.random() < 0.04:
            row[rng.choice([3, 4, 5])] = None
        rows.append(tuple(row))
    slots = {(1, 1): 6, (1, 2): 1, (2, 2): 3}
    queued = spark.createDataFrame(
        rows, "g long, p long, id long, pedido timestamp_ntz, retirada timestamp_ntz, devolucao timestamp_ntz"
    )
    given = spark.createDataFrame([(*k, n) for k, n in slots.items()], "g long, p long, vagas long")
    got = waiting_queue(queued, given, ["g", "p"], "id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_queue(rows, slots)
    assert waiting_queue(queued.limit(0), given, ["g", "p"], "id").count() == 0


def test_yard_inventory(spark):
    rng = random.Random(5)
    t0 = datetime(2026, 1, 1)
    made = {"G3": [], "G4": []}
    for source, rows in made.items():
        for _ in range(300):
            out = t0 + timedelta(hours=6 * rng.randrange(200))
            back = None if rng.random() < 0.1 else out + timedelta(hours=6 * rng.randrange(12))
            rows.append((rng.choice([*range(12), None]), out, back, rng.choice([1, 2, 3, 8, None]) if back else None))
    frames = {
        "g3_locacao": spark.createDataFrame(
            made["G3"], "id_veiculo long, data_locacao timestamp_ntz, data_devolucao timestamp_ntz, id_patio_entrega long"
        ),
        "g4_locacao": spark.createDataFrame(
            made["G4"], "id_veiculo long, dt_retirada timestamp_ntz, dt_chegada timestamp_ntz, id_patio_entrega long"
        ),
    }
    yards = spark.createDataFrame([(s, y) for s in ("G1", "G3", "G4") for y in (1, 2, 3)], "fonte_grupo string, id_patio long")
    days = [day(n) for n in (-1, 0, 3, 3, 9, 20, 21, 49, 90)]
    got = {(r.fonte_grupo, r.id_patio, r.dia): r.veiculos for r in yard_inventory(frames, yards, days).collect()}
    want = {(s, y, d): 0 for s in made for y in (1, 2, 3) for d in days}
    for source, rows in made.items():
        for d in set(days):
            for vehicle in range(12):
                moves = []
                for v, out, back, yard in rows:
                    if v == vehicle:
                        moves.append((out, 0, -1))
                        moves += [(back, 1, -1 if yard is None else yard)] if back else []
                seen = [m for m in moves if m[0].date() <= d]
                if seen and max(seen)[2] in (1, 2, 3):
                    want[source, max(seen)[2], d] += 1
    assert got == want
