"""Fleet availability by day and group, and the waiting queue for vehicles.

Availability is an event sweep: a reservation is +1 on its first day and -1
behind its last, events are summed by (group, day) before any shuffle, and a
running sum over days gives what is out. The running sum is distributed: days
are ranges, ranges give totals, and only totals meet in a window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days in one range of the running sum: a group's sums inside it are one window partition of at most as many rows.
RANGE_DAYS = 64


def running_sum(events: DataFrame, keys: list[str], at: str, value: str, width: int = RANGE_DAYS) -> DataFrame:
    """``events`` with ``total``: the sum of ``value`` up to and including each row's ``at``, for each key.

    ``at`` is a whole number that a key holds once. A window over a key alone
    would put a hot key's rows into one task; here a window holds at most
    ``width`` rows, and one row for each range of a key carries the sum on.
    """
    placed = events.withColumn("__part", F.floor(F.col(at) / width))
    inside = Window.partitionBy(*keys, "__part").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*keys, "__part")
        .agg(F.sum(value).alias("__sum"))
        .select(*keys, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__carried"))
    )
    summed = placed.withColumn("__inside", F.sum(value).over(inside))
    return (
        summed.join(carried, [*keys, "__part"])
        .withColumn("total", (F.col("__inside") + F.col("__carried")).cast("long"))
        .select(*events.columns, "total")
    )


def fleet_availability(reservations: DataFrame, fleet: DataFrame, first: Column, last: Column) -> DataFrame:
    """``(fonte_grupo, id_grupo, dia, frota, reservados, livres)`` for each group of the fleet and each day asked for.

    ``reservations`` has ``fonte_grupo, id_grupo, retirada, devolucao`` as
    dates; a vehicle is out from the pickup to the day of the return, both
    included. Without a return day it stays out; reservations without a pickup
    day or a group, or that end before they begin, hold nothing. ``fleet`` has
    ``fonte_grupo, id_grupo, frota``; ``livres`` is negative where more is
    reserved than there is. Days run from ``first`` to ``last``.
    """
    keys = ["fonte_grupo", "id_grupo"]
    held = reservations.where("id_grupo IS NOT NULL AND retirada IS NOT NULL AND (devolucao IS NULL OR devolucao >= retirada)")
    day = F.unix_date
    events = held.select(
        *keys,
        F.explode(
            F.array(
                F.struct(day("retirada").alias("dia"), F.lit(1).cast("long").alias("n")),
                F.struct((day("devolucao") + 1).alias("dia"), F.lit(-1).cast("long").alias("n")),
            )
        ).alias("e"),
    ).select(*keys, "e.*").where("dia IS NOT NULL")
    # What begins before the first day is there on it.
    changes = events.select(*keys, F.greatest("dia", day(first)).alias("dia"), "n").where(F.col("dia") <= day(last))
    changes = changes.groupBy(*keys, "dia").agg(F.sum("n").alias("n"))
    days = fleet.select(*keys, F.explode(F.sequence(day(first), day(last))).alias("dia"), F.lit(0).cast("long").alias("n"))
    daily = days.unionByName(changes).groupBy(*keys, "dia").agg(F.sum("n").alias("n"))
    out = running_sum(daily, keys, "dia", "n")
    return out.join(fleet, keys).select(
        *keys,
        F.date_from_unix_date("dia").alias("dia"),
        F.col("frota").cast("long").alias("frota"),
        F.col("total").alias("reservados"),
        (F.col("frota") - F.col("total")).cast("long").alias("livres"),
    )


# -- the waiting queue -------------------------------------------------------------


def waiting_queue(queued: DataFrame, slots: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """``(keys, id, espera, vaga)``: the vehicle each queued reservation gets, or none.

    ``queued`` has the keys (longs), an id, ``pedido`` (when it was asked for),
    ``retirada`` and ``devolucao``; ``slots`` has the keys once each and
    ``vagas``, the number of vehicles of a queue. First come, first served: in
    order of ``pedido``, then id, a reservation gets the vehicle that is free
    first, the lowest number first among equals, if that is free when the
    reservation begins; else it waits (``vaga`` NULL). ``espera`` is its place
    in the queue. Without a time, or if it ends before it begins, it waits, and
    so does one of a queue without vehicles or with a NULL key. Rows that
    share an id are reservations of their own.

    Queues are distributed; a queue's order is what it is about, so each is
    read by one task, in Spark's sort order and a batch at a time. What a task
    holds is one heap, of the vehicles of the queue it is in.
    """
    named = [f"k{i}" for i in range(len(keys))]
    lines = queued.join(slots.select(*keys, F.col("vagas").cast("int").alias("vagas")), keys, "left").select(
        *(F.col(k).cast("long").alias(n) for k, n in zip(keys, named, strict=True)),
        F.col(id_col).cast("long").alias("id"),
        *(F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("pedido", "retirada", "devolucao")),
        F.coalesce("vagas", F.lit(0)).alias("vagas"),
    )
    names = [*named, "id", "espera", "vaga"]
    types = [*(pa.int64() for _ in named), pa.int64(), pa.int64(), pa.int32()]

    def serve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, heap, place = None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*named, "id", "pedido", "retirada", "devolucao", "vagas")]
            served = []
            for *key, i, asked, begins, ends, n in zip(*columns, strict=True):
                if key != queue:
                    queue, place = key, 0
                    heap = [(-(2**63), v) for v in range(1, n + 1)]
                place += 1
                ready = asked is not None and begins is not None and ends is not None and ends >= begins
                vaga = None
                if ready and heap and None not in key and heap[0][0] <= begins:
                    vaga = heap[0][1]
                    heapq.heapreplace(heap, (ends, vaga))
                served.append((*key, i, place, vaga))
            if served:
                columns = zip(*served, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = ", ".join(f"{n} long" for n in named) + ", id long, espera long, vaga int"
    order = [*named, "pedido", "id", "retirada", "devolucao"]
    done = lines.repartition(*named).sortWithinPartitions(*order).mapInArrow(serve, schema)
    return done.toDF(*keys, id_col, "espera", "vaga")
