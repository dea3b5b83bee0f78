"""Helpers of the operators: tables in the shared folder, sorted groups inside a task, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar.session import checkpoint_ready, shared_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the folder all executors share and read it back.

    It cuts the lineage, survives lost executors and gives Spark the real size
    of the table when it plans the next join.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/yardstar/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``c0, c1, ...`` and the number of each name, so that working columns can't clash with it."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def checkpoint(df: DataFrame) -> DataFrame:
    checkpoint_ready(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut a stream sorted by ``keys`` into tables of whole groups, with the start of each group.

    A table holds a batch and one group more at most, so callers must have
    bounded their groups. Keys are non-null integers.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        starts = group_starts([table[k].to_numpy() for k in keys])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.zeros(1, np.int64)


def group_starts(keys: Sequence[np.ndarray]) -> np.ndarray:
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` nodes reaches through the links ``(a, b)``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of ``edges``: the smallest node it is connected to.

    Alternating large-star and small-star rounds: each node's neighbours are
    hung on the smallest one, first those above the node, then those below it.
    The edges stay a distributed table throughout, never grow, and are
    checkpointed each round; a hub's rows are reduced map-side to its minimum,
    and AQE splits its side of the join. Self-links and NULLs are ignored.
    """
    stars = checkpoint(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    seen = _state(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpoint(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        now = _state(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal if no edge has changed."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def matrices(vectors: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix of doubles)`` for each length among the vectors of a list column without NULLs."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    widths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(widths) - widths
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, flat[starts[rows][:, None] + np.arange(width)]
