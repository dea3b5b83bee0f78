"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, reranking with the original vectors."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar.llm.common import components, local_labels, materialize, matrices, whole_groups


class Codes(NamedTuple):
    """Binary codes of vectors of one length, cut into the keys of the Hamming tables."""

    planes: np.ndarray  # (width, bits), through the origin
    tables: int
    key_bits: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables): the substring of each row's code that each table is keyed by."""
        bits = (unit @ self.planes > 0).reshape(len(unit), self.tables, self.key_bits)
        return bits @ (1 << np.arange(self.key_bits, dtype=np.int64))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def table_shape(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """``(tables, bits of a key)`` for a number of rows.

    Keys get longer with the rows, so that buckets stay small. A random plane
    through the origin separates two vectors at the threshold with probability
    angle / pi, which gives the chance that they agree on a whole key, and so
    the number of tables for which they meet with probability ``recall``.
    """
    key_bits = min(20, max(6, round(math.log2(max(rows, 2))) - 5))
    agree = (1 - math.acos(threshold) / math.pi) ** key_bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))), key_bits


def threshold_pairs(sample: np.ndarray, threshold: float, most: int = 2_000, seed: int = 2) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two sets of pairs at exactly the threshold: sample vectors turned in any direction, and turned towards other ones."""
    x = sample[:most]
    out = []
    for away in (np.random.default_rng(seed).standard_normal(x.shape), np.roll(x, 1, axis=0)):
        away = away - (away * x).sum(axis=1, keepdims=True) * x
        length = np.sqrt((away * away).sum(axis=1))
        some = length > 1e-6  # not the vector itself or its opposite
        turned = threshold * x[some] + math.sqrt(max(0.0, 1 - threshold**2)) * away[some] / length[some, None]
        out.append((x[some], turned))
    return out


def learn_codes(
    sample: np.ndarray, rows: int, threshold: float, recall: float, rounds: int = 30, seed: int = 1
) -> Codes:
    """Iterative quantisation on a sample of unit vectors.

    The sample is centred and projected on its principal axes; a rotation is
    then alternately fitted to the signs of the projection and the signs taken
    again. One rotation yields as many bits as there are axes; longer codes
    take further rotations, from other random starts. The bits are the signs of
    the vectors as they are, not centred: a shift would widen the angle
    of pairs near the mean, and cosines are angles at the origin.

    Fitted planes aren't random ones (in few dimensions all starts may end in
    the same), so ``table_shape`` is where the number of tables begins: tables
    of random planes are added until both sets of ``threshold_pairs`` meet with
    ``recall``.
    """
    width = sample.shape[1]
    centred = sample - sample.mean(axis=0)
    _, axes = np.linalg.eigh(centred.T @ centred)
    projected = centred @ axes
    rng = np.random.default_rng(seed)
    tables, key_bits = table_shape(rows, threshold, recall)
    fitted = []
    for _ in range(-(-tables * key_bits // width)):
        rotation, _ = np.linalg.qr(rng.standard_normal((width, width)))
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(projected @ rotation > 0, 1.0, -1.0).T @ projected)
            rotation = (u @ v).T
        fitted.append(axes @ rotation)
    # Neighbouring bits of a rotation go to different tables.
    order = np.arange(tables * key_bits).reshape(key_bits, tables).T.ravel()
    codes = Codes(np.concatenate(fitted, axis=1)[:, order], tables, key_bits)
    pairs = [(x, y) for x, y in threshold_pairs(sample, threshold) if len(x)]
    while any((codes.keys(x) == codes.keys(y)).any(axis=1).mean() < recall for x, y in pairs):
        more = -(-codes.tables // 16)
        random = rng.standard_normal((width, more * key_bits))
        codes = Codes(np.concatenate([codes.planes, random], axis=1), codes.tables + more, key_bits)
    return codes


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.99,
    sample_rows: int = 20_000,
    block_rows: int = 1_024,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row by cosine >= ``threshold``, in double precision.

    Equal vectors become one class first. Codes are learnt on at most
    ``sample_rows`` classes (those with the smallest hash, a bounded sample)
    and every class is entered in every table. A bucket larger than
    ``block_rows`` is dealt into blocks, and each pair of its blocks is one
    group, so no bucket meets in one task whole. A group computes all its
    cosines as one matrix product. A pair that meets in several tables counts
    in the first of them only. A group gives each row's number of links and one
    link towards its local component: sums instead of pairs, so nothing is
    emitted for each pair of a dense cluster.

    Links are a subset of the true ones, all of them at or above the threshold
    (``recall`` is what is aimed at for pairs exactly at it, and measured on
    pairs made from the sample; it is higher above). Vectors that share a common
    direction have fuller buckets, which cost time and lose nothing. Rows with a NULL id, or whose vector is NULL, empty, zero, or holds
    NULL or non-finite components link with nothing: 0 links and a component
    of their own. Vectors of different length don't link. Repeated rows link
    with each other; rows that share an id share its component and the links of
    all of them. Other columns are left out.
    """
    keys = vectors.select(
        F.col(id_col).alias("id"),
        F.col(vector_col).alias("x"),
    )
    usable = (
        F.col("id").isNotNull()
        & F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & F.exists("x", lambda c: c != 0)
    )
    hashes = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2")]
    keys = keys.select("*", F.when(usable, F.struct(*hashes)).alias("h"))
    classes = keys.where("h IS NOT NULL").groupBy("h").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("x").alias("x")
    )
    classes = materialize(classes, "vectors")
    width = F.size("x")
    widths = {r.w: r.n for r in classes.groupBy(width.alias("w")).agg(F.count("*").alias("n")).collect()}
    total = sum(widths.values())
    codes = {}
    for w, n in widths.items():
        share = max(1, sample_rows * n // total)
        rows = classes.where(width == w).select("rep", "x").orderBy(F.xxhash64("rep"), "rep").limit(share).toArrow()
        _, x = next(matrices(rows["x"]))
        codes[w] = learn_codes(unit_vectors(x), n, threshold, recall)
    linked = _linked(classes, codes, threshold, block_rows)
    if linked is None:
        found = classes.select("h", "rep", (F.col("n") - 1).alias("n_links"), F.col("rep").alias("component_id"))
    else:
        linked = materialize(linked, "vector-links")
        sums = linked.groupBy("id").agg(F.sum("links").alias("links"))
        reached = components(linked.where("id != other"), "id", "other")
        found = (
            classes.drop("x")
            .join(sums, F.col("rep") == F.col("id"), "left")
            .join(reached, F.col("rep") == F.col("node"), "left")
            .select(
                "h",
                "rep",
                (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"),
            )
        )
    found = found.withColumnRenamed("h", "_h")
    out = keys.select("id", "h").join(found, F.col("h") == F.col("_h"), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _linked(classes: DataFrame, codes: dict[int, Codes], threshold: float, block_rows: int) -> DataFrame | None:
    """``(id, links, other)`` parts of each class from each group; None without classes."""
    if not codes:
        return None
    most_tables = max(c.tables for c in codes.values())

    def enter(batches: Iterable[pa.RecordBatch], with_vector: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch["x"]):
                code = codes[x.shape[1]]
                key = code.keys(unit_vectors(x))
                buckets = ((x.shape[1] * most_tables + np.arange(code.tables)) << 20) | key
                columns = {"bucket": pa.array(buckets.ravel())}
                if with_vector:
                    copies = pa.array(np.repeat(rows, code.tables))
                    columns |= {c: batch[c].take(copies) for c in ("rep", "n", "x")}
                    columns["n_table"] = pa.array(np.tile(np.arange(code.tables, dtype=np.int32), len(rows)))
                yield pa.RecordBatch.from_pydict(columns)

    def pieces(batches: Iterable[pa.RecordBatch], with_vector: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield from enter([batch.slice(at, 1000)], with_vector)

    counted = classes.select("x").mapInArrow(lambda b: pieces(b, False), "bucket long").groupBy("bucket").count()
    large = materialize(counted.where(F.col("count") > block_rows), "large-buckets")
    x_type = classes.schema["x"].dataType.simpleString()
    entered = classes.select("rep", "n", "x").mapInArrow(
        lambda b: pieces(b, True), f"bucket long, rep {classes.schema['rep'].dataType.simpleString()}, n long, x {x_type}, n_table int"
    )
    dealt = entered.join(
        large.select(F.col("bucket").alias("_large"), F.ceil(F.col("count") / block_rows).alias("_blocks")),
        F.col("bucket") == F.col("_large"),
        "left",
    ).select("*", F.coalesce("_blocks", F.lit(1)).alias("blocks"))
    dealt = dealt.select("*", F.pmod(F.xxhash64("rep"), "blocks").alias("block"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("partner"))
    dealt = dealt.select(
        "bucket",
        F.least("block", "partner").alias("low"),
        F.greatest("block", "partner").alias("high"),
        "block",
        "n_table",
        F.col("rep").cast("long").alias("rep"),
        "n",
        "x",
    )

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["bucket", "low", "high"]):
            many = np.diff([*starts, table.num_rows])
            out_id, out_links, out_other = [], [], []
            for start, n in zip(starts[many > 1], many[many > 1], strict=True):
                part = table.slice(start, n)
                rep, copies, block = (part[c].to_numpy() for c in ("rep", "n", "block"))
                low, high, at = (part[c][0].as_py() for c in ("low", "high", "n_table"))
                [(_, x)] = matrices(part["x"])
                unit = unit_vectors(x)
                near = unit @ unit.T >= threshold
                near &= (block == low)[:, None] & (block == high)[None, :]
                if low == high:
                    near = np.triu(near, 1)
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                keys = codes[x.shape[1]].keys(unit)[:, : at + 1]
                first = (keys[a] == keys[b]).argmax(axis=1) == at
                a, b = a[first], b[first]
                links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
                label = local_labels(n, a, b)
                of = np.flatnonzero(links)
                out_id.append(rep[of])
                out_links.append(links[of].astype(np.int64))
                out_other.append(rep[label[of]])
            if out_id:
                columns = map(np.concatenate, (out_id, out_links, out_other))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "links", "other"])

    return (
        dealt.repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(link, "id long, links long, other long")
    )
