"""Exact top-k search with the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardstar.llm.common import matrices, whole_groups


class Lists:
    """The sorted lists of a block of vectors: for each dimension, the rows by ascending component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` highest inner products, ties to the smaller id.

        Each step reads the next stretch of every list from the end that the
        query's sign prefers and scores the rows not met before. No unmet row
        can score more than the sum of the last components read, so the search
        ends when the kth score is above that bound; at equality an unmet row
        with a smaller id could still tie, so it goes on.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = self.ids == query_id
        best = np.zeros(0, np.int64)
        score = np.zeros(0, self.vectors.dtype)
        depth, step = 0, 16
        while True:
            end = min(n, depth + step)
            new = np.zeros(n, bool)
            new[self.order[n - end : n - depth, up]] = True
            new[self.order[depth:end, down]] = True
            if end == n:
                new[:] = True  # also the case of a query of zeros, which has no list to read
            rows = np.flatnonzero(new & ~met)
            met[rows] = True
            rows = np.concatenate([best, rows])
            score = self.vectors[rows] @ query
            keep = np.lexsort((rows, -score))[:k]
            best, score = rows[keep], score[keep]
            if end == n or met.all():
                return best, score
            bound = (self.vectors[self.order[n - end, up], up] * query[up]).sum()
            bound += (self.vectors[self.order[end - 1, down], down] * query[down]).sum()
            if len(best) == k and score[-1] > bound:
                return best, score
            depth, step = end, 2 * step


def _whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` of each component, as doubles while every inner product is exact in them."""
    x = np.floor(256.0 * vectors)
    top = float(np.abs(x).max(initial=0))
    if top * top * max(x.shape[1], 1) < 2.0**53:
        return x
    return np.vectorize(int, otypes=[object])(x)


def top_inner_products(
    vectors: DataFrame,
    query_ids: str,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rows_per_block: int = 32_768,
    queries_per_block: int = 4_096,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner products of each query.

    ``query_ids`` is a SQL condition over the table that picks the queries;
    candidates are all rows but those of the query's own id. Components become
    ``floor(256 * x)``, x as double; scores are exact whole numbers and must fit
    a long. Ties go to the smaller id; fewer candidates give fewer rows.

    Queries and candidates are dealt into blocks by a hash of the id, and each
    pair of blocks is one group: it builds the sorted lists of its candidates
    once and runs the threshold algorithm for each of its queries. Only k rows
    a query leave a group. Blocks are bounded, so nothing grows with a hot
    value; a candidate is copied once for each query block.

    Rows with NULL id, a NULL vector, or NULL or non-finite components take no
    part; vectors of different length aren't compared. Repeated rows are
    candidates of their own. No queries or no candidates: no rows.
    """
    valid = vectors.where(
        F.col(id_col).isNotNull()
        & F.col(vector_col).isNotNull()
        & F.forall(
            vector_col,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        )
    )
    rows = valid.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("x"),
        F.coalesce(F.expr(query_ids), F.lit(False)).alias("is_query"),
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-counts.n // rows_per_block), min(2 * cores, -(-counts.n // 1024)))
    q_blocks = max(1, -(-counts.q // queries_per_block))
    hashed = F.xxhash64("id")
    candidates = rows.select(
        F.pmod(hashed, F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"),
        F.lit(0).alias("kind"),
        "id",
        "x",
    )
    queries = rows.where("is_query").select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(q_blocks)).cast("int").alias("q_block"),
        F.lit(1).alias("kind"),
        "id",
        "x",
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for table, starts in whole_groups(batches, ["block", "q_block"]):
            for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
                part = table.slice(start, end - start)
                ids, kinds = part["id"].to_numpy(), part["kind"].to_numpy()
                for of, x in matrices(part["x"]):
                    numbers = _whole_numbers(x)
                    is_query = kinds[of] == 1
                    if is_query.all() or not is_query.any():
                        continue
                    lists = Lists(ids[of][~is_query], numbers[~is_query])
                    for q, query in zip(ids[of][is_query], numbers[is_query], strict=True):
                        found, score = lists.search(q, query, k)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(found), q)),
                                pa.array(lists.ids[found]),
                                pa.array([int(s) for s in score], pa.int64()),
                            ],
                            schema=schema,
                        )

    found = (
        candidates.unionByName(queries)
        .repartition(n_blocks * q_blocks, "block", "q_block")
        .sortWithinPartitions("block", "q_block")
        .mapInArrow(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
