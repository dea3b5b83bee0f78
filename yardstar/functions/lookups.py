"""Lookup joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    spread_nulls_by: Sequence[str] = (),
    lowest: bool = False,
    hot: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``right`` to ``left`` on ``{left column: right column}`` and take ``{right column: new name}``.

    No broadcast hint is given: Spark broadcasts ``right`` if its size is under
    the threshold and otherwise sort-merges with AQE's skew split. Rows whose
    key is NULL match nothing but would all hash to one partition; with
    ``spread_nulls_by`` they are placed by a hash of these columns instead, and
    a residual condition keeps them from matching. ``null_safe`` makes NULL
    equal to NULL.

    With ``lowest`` several matches count as one with the lowest value of each
    taken column; the join then uses the partitioning of that aggregation. AQE
    splits a hot key only where a join reads both sides straight from a
    shuffle: say ``hot`` where one key may hold a large share of ``left``, and
    the reduced side is shuffled once more.
    """
    keys = {l: f"__key_{i}" for i, l in enumerate(on)}
    kept = left.columns
    found = right.select(
        *(F.col(r).alias(keys[l]) for l, r in on.items()), *(F.col(r).alias(n) for r, n in take.items())
    )
    if lowest:
        found = found.groupBy(*keys.values()).agg(*(F.min(n).alias(n) for n in take.values()))
    matches = F.lit(True)
    for i, (l, k) in enumerate(keys.items()):
        if null_safe:
            matches = matches & F.col(f"`{l}`").eqNullSafe(F.col(k))
            continue
        mine, kind = F.col(f"`{l}`"), found.schema[k].dataType
        stand_in = _stand_in(kind, spread_nulls_by) if spread_nulls_by else None
        if stand_in is not None:
            left = left.withColumns({f"__at_{i}": F.coalesce(mine.cast(kind), stand_in), f"__has_{i}": mine.isNotNull()})
            matches = matches & (F.col(f"__at_{i}") == F.col(k)) & F.col(f"__has_{i}")
        else:
            matches = matches & (mine == F.col(k))
    if hot and lowest:
        # Always 0, but not a literal: Catalyst would fold a literal into the
        # condition and the column would no longer be a partitioning key.
        found = found.selectExpr("*", f"pmod(xxhash64({', '.join(keys.values())}), 1) AS __same")
        left = left.withColumn("__zero", F.pmod(F.xxhash64(*(F.col(f"`{l}`") for l in keys)), F.lit(1)))
        matches = matches & (F.col("__zero") == F.col("__same"))
    return left.join(found, matches, how).select(*kept, *take.values())


def _stand_in(kind: T.DataType, by: Sequence[str]) -> Column | None:
    """A value of ``kind`` that places a row without a key; None for kinds that take none."""
    spread = F.xxhash64(*by)
    if isinstance(kind, T.LongType):
        return spread
    if isinstance(kind, T.IntegerType):
        return F.pmod(spread, F.lit(2**31 - 1)).cast("int")
    if isinstance(kind, T.StringType):
        return spread.cast("string")
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(spread, F.lit(1_000_000)).cast("int"))
    return None
