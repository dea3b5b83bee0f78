"""Hard-negative mining: clusters of anchors walk one list of candidates, sorted by angular upper bound, until certified."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardstar.llm.common import materialize, matrices, whole_groups
from yardstar.llm.topk import _whole_numbers as whole_numbers

#: Bounds are made of doubles, angles near zero are good to 2e-8 only: bounds are raised by more than they can be off.
SLACK = 1e-7


# -- clusters of anchors -------------------------------------------------------


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def spherical_centers(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """``k`` unit vectors that the rows of ``x`` gather around by angle."""
    unit = _unit(x)
    rng = np.random.default_rng(seed)
    centers = unit[rng.choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(rounds):
        of = np.argmax(unit @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, of, unit)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(size > 0, sums / np.maximum(size, 1e-300), centers)
    return centers


# -- the walk ------------------------------------------------------------------


class SharedList:
    """Candidates in descending order of what they can score at most with any member of the cluster.

    A candidate at angle t to the cluster's center can't be nearer to a member
    than t less the widest angle of a member, so its inner product with a
    member, divided by the member's length, is at most its own length times the
    cosine of that difference.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, members: np.ndarray):
        middle = _unit(_unit(members.astype(np.float64)).sum(axis=0, keepdims=True))[0]
        spread = _angles(members, middle).max()
        away = np.maximum(_angles(vectors, middle) - spread - SLACK, 0.0)
        bound = _lengths(vectors) * np.cos(away) * (1 + SLACK)
        order = np.argsort(-bound, kind="stable")
        self.bound, self.ids, self.vectors = bound[order], ids[order], vectors[order]


def _lengths(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    top = np.maximum(np.abs(x).max(axis=1), 1e-300)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def _angles(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    # Zero vectors have no angle: their length makes the bound zero whatever it is.
    return np.arccos(np.clip(_unit(x.astype(np.float64)) @ middle, -1.0, 1.0))


def walk(
    shared: SharedList, members: np.ndarray, member_ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, step: int = 512
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` candidates of each member's windows: ``(member, window, place in the list, score)``.

    ``low`` and ``high`` are (members, windows): a candidate counts in a window
    if its score lies between them, ends included, and it is not of the
    member's own id. Higher scores come first, ties by smaller id. A window
    ends when the bound of the rest of the list is below its kth score or its
    lower end, a member when all its windows have ended.
    """
    n_windows = low.shape[1]
    reach = _lengths(members) * (1 + SLACK)
    best = [np.zeros(0, np.int64)] * 3  # member, window, place
    score = np.zeros(0, members.dtype)
    floor = low.copy()  # what a candidate must score to change a window
    active = np.arange(len(members))
    at = 0
    while at < len(shared.ids) and len(active):
        end = min(len(shared.ids), at + step)
        scores = members[active] @ shared.vectors[at:end].T
        fits = member_ids[active][:, None] != shared.ids[at:end]
        found, its_scores = [best], [score]
        for w in range(n_windows):
            inside = fits & (scores >= floor[active, w][:, None]) & (scores <= high[active, w][:, None])
            row, column = np.nonzero(inside)
            found.append([active[row], np.full(len(row), w), at + column])
            its_scores.append(scores[row, column])
        of, window, place = (np.concatenate(x) for x in zip(*found, strict=True))
        score = np.concatenate(its_scores)
        order = np.lexsort((shared.ids[place], -score, window, of))
        of, window, place, score = of[order], window[order], place[order], score[order]
        group = of * n_windows + window
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        kept = rank < k
        full = rank == k - 1
        floor[of[full], window[full]] = score[full]
        best, score = [of[kept], window[kept], place[kept]], score[kept]
        at = end
        if at < len(shared.ids):
            # A negative bound times a length that is rounded up would be too low; zero is a bound then as well.
            most = reach[active] * max(shared.bound[at], 0.0) + SLACK
            active = active[(most[:, None] >= floor[active]).any(axis=1)]
    return *best, score


# -- the operator ----------------------------------------------------------------


def _rows(vectors: DataFrame, id_col: str, label: str, vector_col: str, anchor_ids: str) -> DataFrame:
    """Valid rows as ``(id, label, x, is_anchor, copies)``, equal ones as one."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good)
    rows = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.expr(label).cast("long").alias("label"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("x"),
        F.coalesce(F.expr(anchor_ids), F.lit(False)).alias("is_anchor"),
    ).where("label IS NOT NULL AND size(x) > 0")
    return rows.groupBy("id", "label", "x", "is_anchor").agg(F.count("*").alias("copies"))


def _searched(
    anchors: DataFrame, candidates: DataFrame, same_label: bool, n_blocks: int, k: int, low_percent: int, high_percent: int
) -> DataFrame:
    """``(anchor, window, id, score)``: the first ``k`` candidates of each anchor's windows in each block of candidates.

    Windows are those of ``anchors.scores`` in turn, one without limits where
    that is NULL. A candidate goes to its block only; anchors go to every
    block, and stream through the task that holds it, one cluster at a time.
    """
    block = F.pmod(F.xxhash64("id", "label", "x", "copy"), F.lit(n_blocks)).cast("int")
    held = candidates.select(
        block.alias("block"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("cluster"),
        "id",
        "label",
        "x",
        F.lit(None).cast("array<decimal(38,0)>").alias("scores"),
    )
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    asking = anchors.select(every_block.alias("block"), F.lit(1).alias("kind"), "cluster", "id", "label", "x", "scores")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
        block, lists = None, {}
        for table, starts in whole_groups(batches, ["block", "kind", "cluster"]):
            for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
                part = table.slice(start, end - start)
                ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
                if part["kind"][0].as_py() == 0:
                    block = part["block"][0].as_py()
                    lists = {x.shape[1]: (ids[of], labels[of], x) for of, x in matrices(part["x"])}
                    continue
                if part["block"][0].as_py() != block:
                    continue  # a block without candidates
                scores = part["scores"].to_pylist()
                for of, x in matrices(part["x"]):
                    if x.shape[1] not in lists:
                        continue
                    its_ids, its_labels, its_x = lists[x.shape[1]]
                    use = (its_labels == labels[0]) == same_label
                    if not use.any():
                        continue
                    numbers = whole_numbers(np.concatenate([x, its_x[use]]))
                    members = numbers[: len(x)]
                    shared = SharedList(its_ids[use], numbers[len(x) :], members)
                    low, high = _windows([scores[i] for i in of], low_percent, high_percent, numbers.dtype)
                    member, window, place, score = walk(shared, members, ids[of], low, high, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[of][member]),
                            pa.array(window.astype(np.int32)),
                            pa.array(shared.ids[place]),
                            pa.array([int(s) for s in score], pa.int64()),
                        ],
                        schema=schema,
                    )

    order = ["block", "kind", "cluster"]
    dealt = held.unionByName(asking).repartition(n_blocks, "block").sortWithinPartitions(*order)
    return dealt.mapInArrow(search, "anchor long, window int, id long, score long")


def _windows(scores: list, low_percent: int, high_percent: int, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score of each window; a window that is not there holds nothing."""
    if scores[0] is None:
        return np.full((len(scores), 1), -np.inf, dtype), np.full((len(scores), 1), np.inf, dtype)
    wide = max(map(len, scores))
    low, high = np.full((len(scores), wide), np.inf, dtype), np.full((len(scores), wide), -np.inf, dtype)
    for i, its in enumerate(scores):
        for w, s in enumerate(its):
            low[i, w], high[i, w] = -(-low_percent * int(s) // 100), high_percent * int(s) // 100
    return low, high


def mine(
    vectors: DataFrame,
    anchor_ids: str,
    n_positives: int = 5,
    n_negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    id_col: str = "vec_id",
    label: str = "label",
    vector_col: str = "embedding",
    rows_per_block: int = 16_384,
    anchors_per_cluster: int = 512,
    most_centers: int = 256,
    sample_values: int = 1 << 20,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)``.

    ``anchor_ids`` is a SQL condition that picks the anchors, ``label`` a SQL
    expression. Components become ``floor(256 * x)``, x as double; a score is
    the whole inner product with the anchor and must fit a long. An anchor's
    positives are the first ``n_positives`` other rows of its label; a
    positive's negatives the first ``n_negatives`` other rows of other labels that
    score from ``low_percent`` to ``high_percent`` of it. Higher scores come
    first, ties by smaller id.

    Anchors are gathered around at most ``most_centers`` centers, fitted on at
    most ``sample_values`` components of anchors, and dealt into clusters of
    about ``anchors_per_cluster`` of one label. For each cluster and block of
    candidates the list is sorted once by angular upper bound and every member
    walks it until the bound certifies that nothing left counts. Positives come
    first, among candidates of the cluster's label, then negatives, among all
    others.

    Rows with a NULL id, label or vector, an empty vector, or NULL or
    non-finite components take no part; vectors of different length aren't
    compared. Rows equal in id, label and vector are candidates of their own;
    of these, as many are looked at as a result can hold. An id that stands
    with several vectors or labels is one anchor, the row with the least label
    and vector; rows of the anchor's id are neither its positives nor its
    negatives. No anchors, or
    no positives or negatives: no rows. Other columns aren't read.
    """
    spark = vectors.sparkSession
    most = max(n_positives, n_negatives)
    rows = materialize(_rows(vectors, id_col, label, vector_col, anchor_ids), "valid-vectors")
    copies = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(most)).cast("int"))
    candidates = rows.select("id", "label", "x", F.explode(copies).alias("copy"))
    anchors = rows.where("is_anchor").groupBy("id").agg(F.min(F.struct("label", "x")).alias("a"))
    anchors = materialize(anchors.select("id", "a.label", "a.x"), "anchors")
    n = rows.agg(F.sum(F.least(F.col("copies"), F.lit(most)))).first()[0] or 0
    n_blocks = max(1, -(-n // rows_per_block), min(2 * spark.sparkContext.defaultParallelism, n // 1024))
    clustered = materialize(_clustered(anchors, anchors_per_cluster, most_centers, sample_values), "clustered-anchors")
    asking = clustered.withColumn("scores", F.lit(None).cast("array<decimal(38,0)>"))
    near = _searched(asking, candidates, True, n_blocks, n_positives, low_percent, high_percent)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc("id"))
    positives = near.withColumn("positive_rank", F.row_number().over(order)).where(F.col("positive_rank") <= n_positives)
    positives = materialize(positives.select("anchor", "positive_rank", F.col("id").alias("positive"), "score"), "positives")
    targets = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "score"))).alias("p"))
    targets = targets.select(F.col("anchor").alias("id"), F.expr("transform(p, x -> cast(x.score AS decimal(38,0)))").alias("scores"))
    hard = _searched(clustered.join(targets, "id"), candidates, False, n_blocks, n_negatives, low_percent, high_percent)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("id"))
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    hard = hard.select("anchor", (F.col("window") + 1).alias("positive_rank"), "rank", "id", F.col("score").alias("negative_score"))
    return hard.join(positives, ["anchor", "positive_rank"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        "negative_score",
        "positive_rank",
    )


def _clustered(anchors: DataFrame, size: int, most_centers: int, sample_values: int) -> DataFrame:
    """``anchors`` with the number of their cluster: one label, one center, and a share of their number."""
    widths = anchors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return anchors.withColumn("cluster", F.lit(0).cast("long"))
    width, n = widths
    sample = anchors.where(F.size("x") == width).orderBy(F.xxhash64("id")).limit(max(most_centers, sample_values // width))
    x = np.array([r.x for r in sample.select("x").collect()], np.float64)
    centers = spherical_centers(x, int(min(most_centers, max(1, n // size))))

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            center = np.zeros(batch.num_rows, np.int32)
            for of, x in matrices(batch.column("x")):
                if x.shape[1] == width:
                    center[of] = np.argmax(_unit(x) @ centers.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(center)], [*batch.schema.names, "center"])

    placed = anchors.mapInArrow(nearest, "id long, label long, x array<double>, center int")
    sizes = placed.groupBy("label", "center").agg(F.ceil(F.count("*") / size).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    return placed.join(sizes, ["label", "center"]).select("id", "label", "x", F.xxhash64("label", "center", part).alias("cluster"))
