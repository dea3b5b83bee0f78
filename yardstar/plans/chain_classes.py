"""Structure and long-run shares of a yard chain that need not converge.

A chain may split into classes of yards, and a class may be periodic. Classes
and periods come from shortest paths between yards; the long run comes from the
lazy chain (stay or move with probability one half each), which has the same
long-run averages and always converges.

All tables here hold at most yards squared rows. Squaring doubles the path
length (or the number of moves) each round, so rounds grow with the logarithm
of the yards; each is checkpointed, and two numbers come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar.session import checkpoint_ready


def _moves(matrix: DataFrame) -> DataFrame:
    """``(a, b, p)``: rows scaled to a sum of one; a yard that nothing leaves keeps its vehicles."""
    edges = (
        matrix.where(F.col("patio_origem").isNotNull() & F.col("patio_destino").isNotNull())
        .groupBy(F.col("patio_origem").alias("a"), F.col("patio_destino").alias("b"))
        .agg(F.sum(F.col("probabilidade").cast("double")).alias("w"))
        .where("w > 0")
    )
    sums = edges.groupBy("a").agg(F.sum("w").alias("total"))
    yards = edges.select("a").union(edges.select("b")).distinct()
    stuck = yards.join(sums, "a", "left_anti")
    scaled = edges.join(sums, "a").select("a", "b", (F.col("w") / F.col("total")).alias("p"))
    return scaled.union(stuck.select("a", F.col("a").alias("b"), F.lit(1.0)))


def _distances(moves: DataFrame) -> DataFrame:
    """``(a, b, d)``: fewest moves from yard to yard, for all that can be reached; 0 to itself."""
    steps = moves.select("a", "b", F.when(F.col("a") == F.col("b"), 0).otherwise(1).cast("long").alias("d"))
    loops = moves.select("a").union(moves.select("b")).distinct().select("a", F.col("a").alias("b"), F.lit(0).cast("long"))
    paths = steps.union(loops).groupBy("a", "b").agg(F.min("d").alias("d")).checkpoint()
    seen = None
    while True:
        state = tuple(paths.agg(F.count("*"), F.sum("d")).first())
        if state == seen:
            return paths
        seen = state
        second = paths.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("d").alias("d2"))
        paths = (
            paths.join(second, "b")
            .groupBy("a", F.col("c").alias("b"))
            .agg(F.min(F.col("d") + F.col("d2")).alias("d"))
            .checkpoint()
        )


def communicating_classes(matrix: DataFrame) -> DataFrame:
    """``(patio, classe, fechada, periodo)`` per yard of the matrix.

    Yards that reach each other share a class, named by its smallest yard. A
    class is closed (``fechada``) if no move leaves it. ``periodo`` is the
    greatest common divisor of its cycle lengths, found from the moves' levels
    (distance from the class's yard); NULL for a yard that is on no cycle. A yard
    that nothing leaves keeps its vehicles: closed, with period 1. Moves without
    a positive probability and NULL yards count for nothing; an empty matrix
    gives no rows.
    """
    checkpoint_ready(matrix.sparkSession)
    moves = _moves(matrix).checkpoint()
    paths = _distances(moves)
    back = paths.select(F.col("b").alias("a"), F.col("a").alias("b"))
    classes = paths.join(back, ["a", "b"]).groupBy("a").agg(F.min("b").alias("classe"))
    levels = (
        classes.join(paths.select(F.col("a").alias("classe"), F.col("b").alias("a"), "d"), ["classe", "a"])
        .select("a", "classe", "d")
        .checkpoint()
    )
    target = levels.select(F.col("a").alias("b"), F.col("classe").alias("classe_b"), F.col("d").alias("d_b"))
    ends = moves.join(levels, "a").join(target, "b")
    inside = F.col("classe") == F.col("classe_b")
    shape = ends.groupBy("classe").agg(
        F.bool_and(inside).alias("fechada"),
        # At most twice as many differences as the class has yards.
        F.collect_set(F.when(inside, F.abs(F.col("d") + 1 - F.col("d_b")))).alias("gaps"),
    )
    gaps = F.filter("gaps", lambda x: x > 0)
    divisors = F.filter(
        F.sequence(F.lit(1).cast("long"), F.array_min(gaps)), lambda q: F.forall(gaps, lambda x: x % q == 0)
    )
    return levels.join(shape, "classe").select(
        F.col("a").alias("patio"),
        "classe",
        "fechada",
        F.when(F.size(gaps) > 0, F.array_max(divisors)).cast("int").alias("periodo"),
    )


def _limit(moves: DataFrame, tol: float, most: int) -> DataFrame:
    """``(a, b, p)``: where the lazy chain ends from each yard, by repeated squaring."""
    half = moves.select("a", "b", (F.col("p") / 2).alias("p"))
    stay = moves.select("a").distinct().select("a", F.col("a").alias("b"), F.lit(0.5))
    power = half.union(stay).groupBy("a", "b").agg(F.sum("p").alias("p")).checkpoint()
    for _ in range(most):
        second = power.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("p").alias("p2"))
        squared = power.join(second, "b").groupBy("a", F.col("c").alias("b")).agg(F.sum(F.col("p") * F.col("p2")).alias("w"))
        # Scaled again, else a rounding error would double with each round.
        sums = squared.groupBy("a").agg(F.sum("w").alias("total"))
        squared = squared.join(sums, "a").select("a", "b", (F.col("w") / F.col("total")).alias("p")).checkpoint()
        old = power.select("a", "b", F.col("p").alias("old"))
        change = squared.join(old, ["a", "b"], "left").agg(F.max(F.abs(F.col("p") - F.coalesce("old", F.lit(0.0))))).first()[0]
        power = squared
        if (change or 0.0) <= tol:
            return power
    raise RuntimeError(f"the lazy chain still changes by {change} after {most} squarings")


def absorption_shares(matrix: DataFrame, classes: DataFrame, tol: float = 1e-12, most: int = 60) -> DataFrame:
    """``(patio, classe, parcela)``: share of a yard's vehicles that ends in each closed class, to 6 places.

    A yard of a closed class has one row, with 1. Shares that round to 0 stay.
    """
    checkpoint_ready(matrix.sparkSession)
    closed = classes.where("fechada").select(F.col("patio").alias("b"), "classe")
    ends = _limit(_moves(matrix).checkpoint(), tol, most).join(closed, "b")
    return ends.groupBy(F.col("a").alias("patio"), "classe").agg(
        F.round(F.sum("p"), 6).cast("decimal(10,6)").alias("parcela")
    )


def long_run_shares(matrix: DataFrame, tol: float = 1e-12, most: int = 60) -> DataFrame:
    """``(patio, parcela)``: average share of vehicles per yard in the long run from a uniform start, to 6 places.

    It exists for periodic and split chains too, where ``steady_state`` goes
    round or depends on the step. Yards that empty out have 0.
    """
    checkpoint_ready(matrix.sparkSession)
    moves = _moves(matrix).checkpoint()
    n = moves.select("a").distinct().count()
    return (
        _limit(moves, tol, most)
        .groupBy(F.col("b").alias("patio"))
        .agg(F.round(F.sum("p") / F.lit(float(max(n, 1))), 6).cast("decimal(10,6)").alias("parcela"))
    )
