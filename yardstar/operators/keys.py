"""Stable, dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_keys(
    natural: DataFrame,
    keys: Sequence[str],
    workspace: str,
    known: DataFrame | None = None,
    key_name: str = "sk",
) -> DataFrame:
    """Map every natural key of ``natural`` to a surrogate key.

    Keys in ``known`` (columns ``keys`` + ``key_name``) are kept; new ones
    continue after its highest number, in natural-key order, without gaps. A
    first load therefore equals ``row_number() over (order by keys)``.

    The order is made by range partitioning, never by one global window. The
    sorted keys are written to ``workspace`` with their position, so counting
    and numbering read the same partitions even if executors are lost; only
    the running offset, over one row per partition, uses an ordered window.
    """
    spark = natural.sparkSession
    fresh = natural.select(*keys).distinct()
    start = F.lit(0)
    if known is not None:
        k = known.select(*(F.col(c).alias(f"__k_{c}") for c in keys))
        same = None
        for c in keys:
            part = fresh[c].eqNullSafe(k[f"__k_{c}"])
            same = part if same is None else same & part
        fresh = fresh.join(k, same, "left_anti")
        start = F.lit(known.agg(F.max(key_name)).first()[0] or 0)
    (
        fresh.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        # Partition number in the high bits, row position in the low 33.
        .withColumn("__at", F.monotonically_increasing_id())
        .write.mode("overwrite")
        .parquet(workspace)
    )
    placed = spark.read.schema(fresh.schema.add("__at", "long")).parquet(workspace).withColumn("__part", F.shiftright("__at", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    position = F.col("__at").bitwiseAND((1 << 33) - 1)
    # One row per range partition: its size is bounded by the partition count.
    numbered = placed.join(F.broadcast(offsets), "__part").select(
        *keys, (start + F.col("__offset") + position + 1).cast("bigint").alias(key_name)
    )
    return numbered if known is None else known.select(*keys, key_name).unionByName(numbered)
