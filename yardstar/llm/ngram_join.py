"""N-gram Jaccard join over an index of count vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstar.llm.common import components, group_starts, materialize, whole_groups
from yardstar.llm.text import LOWER, buffer, mix, slices, words

SHINGLE = 5
DIMENSIONS = 256  # groups of shingles that a document's point counts
TREE_DIMENSIONS = 64  # of the trees' boxes: groups with equal remainders are added up
# Larger sets have a second point of more groups: counts of unrelated sets differ by the root of the counts, so the more
# shingles there are, the more groups it takes until the differences add up to more than the bound allows.
FINE_DIMENSIONS, FINE_FROM = 1024, 256
FREQUENCY_GROUPS = 1 << 18
LEAF = 32
SMALL = 4  # classes of a bucket all of whose pairs are given at once
PLACE_BITS = 32  # of a shingle's rank in its set; the set's size stands above them
PLACE_MASK = (1 << PLACE_BITS) - 1
SLICE_BYTES = 1 << 19  # of text in one pass: each takes about a hundred times as much in arrays

_FOLD = np.uint64(0xD6E8FEB86659FD93)


class Sets(NamedTuple):
    """The shingle sets of a batch of texts, one after the other, each sorted by hash."""

    hash: np.ndarray
    start: np.ndarray  # of each text's set, and the end of the last

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.start)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), self.size)

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, values.dtype)
        np.cumsum(values, out=total[1:])
        return total[self.start[1:]] - total[self.start[:-1]]

    def classes(self) -> np.ndarray:
        """A number for each set: equal sets have equal numbers."""
        return mix(self.sums(mix(self.hash)) + self.size.astype(np.uint64)).view(np.int64)

    def points(self, kept: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
        """(texts kept, dimensions): how many shingles of each kept text fall into each group."""
        owner = self.owner()
        of = kept[owner]
        at = (np.cumsum(kept) - 1)[owner[of]] * dimensions + (self.hash[of] % np.uint64(dimensions)).astype(np.int64)
        return np.bincount(at, minlength=int(kept.sum()) * dimensions).reshape(-1, dimensions)


def shingle_sets(texts: pa.Array) -> Sets:
    """Distinct runs of ``SHINGLE`` words, A-Z in lower case; the whole sequence of a text with fewer words."""
    data, offsets = buffer(texts)
    found = words(LOWER[data], offsets)
    n_words = np.bincount(found.text, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    hashes, owner = [], []
    for length in range(1, SHINGLE + 1):
        if length == SHINGLE:
            whole = found.text[: -SHINGLE + 1] == found.text[SHINGLE - 1 :]
            at = np.flatnonzero(whole)
        else:
            at = first[n_words == length]
        value = found.hash[at].copy()
        for i in range(1, length):
            value = value * _FOLD + found.hash[at + i]
        hashes.append(mix(value + np.uint64(length)))
        owner.append(found.text[at])
    hash_, owner_ = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((hash_, owner_))
    hash_, owner_ = hash_[order], owner_[order]
    new = np.ones(len(hash_), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (owner_[1:] != owner_[:-1])
    hash_, owner_ = hash_[new], owner_[new]
    return Sets(hash_, np.searchsorted(owner_, np.arange(len(texts) + 1)))


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of ``n`` must share with any set it is linked to."""
    return -(-percent * n // 100)


def bound_passes(minima: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap of at most ``minima`` allows sets of ``n`` and ``m`` to reach the similarity."""
    return (100 + percent) * minima >= percent * (n + m)


# -- documents ---------------------------------------------------------------


def _describe(docs: DataFrame) -> DataFrame:
    """One row for each document, ``(id, n, class, point, fine)``, and from each task rows ``(n = -1, group, count)``.

    The groups' counts say how many shingles fall into each of a fixed number
    of groups: a bounded table that shows which shingles may be frequent.
    """
    id_type = docs.schema["id"].dataType.simpleString()

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FREQUENCY_GROUPS, np.int64)
        kind = None
        names = ["id", "n", "class", "point", "fine"]
        for batch in batches:
            kind = batch.schema.field("id").type
            for some in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(some["text"])
                counts += np.bincount(_frequency_group(sets.hash), minlength=FREQUENCY_GROUPS)
                all_, large = np.ones(len(sets.size), bool), sets.size >= FINE_FROM
                columns = [
                    some["id"],
                    pa.array(sets.size),
                    pa.array(sets.classes()),
                    _lists(sets.points(all_), all_),
                    _lists(sets.points(large, FINE_DIMENSIONS), large),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        if kind is not None:
            group = np.flatnonzero(counts)
            n = len(group)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, kind),
                    pa.array(np.full(n, -1)),
                    pa.array(group),
                    _lists(counts[group][:, None], np.ones(n, bool)),
                    _lists(np.zeros((0, 0)), np.zeros(n, bool)),
                ],
                names,
            )

    return docs.mapInArrow(describe, f"id {id_type}, n long, class long, point array<int>, fine array<int>")


def _lists(rows: np.ndarray, kept: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as the lists of those kept; the others are empty."""
    cut = np.concatenate([[0], np.cumsum(kept * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(rows.ravel().astype(np.int32)))


def _frequency_group(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def _frequent_groups(described: DataFrame) -> np.ndarray:
    """A flag for each frequency group that holds more shingles than most.

    A flag only moves shingles back in the order in which sets are indexed, so
    it does no harm where chance alone has filled a group.
    """
    rows = described.where("n = -1").groupBy("class").agg(F.sum(F.col("point")[0].cast("long")).alias("count")).toArrow()
    counts = np.zeros(FREQUENCY_GROUPS)
    counts[rows["class"].to_numpy()] = rows["count"].to_numpy()
    usual = np.median(counts)
    return counts > usual + np.sqrt(usual) + 16


# -- the index ---------------------------------------------------------------


def _entries(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """``(shingle, class, place)``: the buckets in which each class of equal sets is indexed.

    Shingles are ordered by hash, those of frequent groups last. Two sets that
    reach the similarity share one of the first ``n - least_overlap(n) + 1``
    shingles of both, whatever the order; this one keeps passages that many
    documents share out of the buckets. A task enters a class once. The place
    holds the size of the set and the shingle's rank in it.
    """

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered: set[int] = set()
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(some["text"])
                classes, n = sets.classes(), sets.size
                new = np.zeros(len(n), bool)
                for i, c in enumerate(classes.tolist()):
                    if n[i] and c not in entered:
                        entered.add(c)
                        new[i] = True
                owner = sets.owner()
                order = np.lexsort((sets.hash, frequent[_frequency_group(sets.hash)], owner))
                rank = np.arange(len(owner)) - sets.start[owner]
                first = new[owner] & (rank <= (n - least_overlap(n, percent))[owner])
                of = owner[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.hash[order][first].view(np.int64)),
                        pa.array(classes[of]),
                        pa.array(n[of] << PLACE_BITS | rank[first]),
                    ],
                    ["shingle", "class", "place"],
                )

    return docs.select("text").mapInArrow(enter, "shingle long, class long, place long")


def may_link(place: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets whose first shared shingle has these places can reach the similarity.

    They share nothing before it, so at most what follows it in either. Linked
    sets pass in the bucket of their first shared shingle.
    """
    n, m = place >> PLACE_BITS, other >> PLACE_BITS
    left, right = n - (place & PLACE_MASK), m - (other & PLACE_MASK)
    return bound_passes(np.minimum(left, right), n, m, percent)


def _buckets(entries: DataFrame, percent: int) -> DataFrame:
    """``(shingle, a, b)``: pairs of classes to begin with, and the classes of large buckets.

    A bucket of up to ``SMALL`` classes gives all its pairs ``(NULL, a, b)``
    that may be linked, and is done with. A larger one gives rows
    ``(shingle, class, place)``, and up to ``SMALL`` pairs for each: with the
    bucket's first class and the ones just before it, so that most of a dense
    group is connected before any of its pairs are enumerated, also where its
    members aren't all alike. Each bucket has a random order of its own.
    """

    def pairs_of(rows: np.ndarray, told: int) -> pa.RecordBatch:
        """Of whole buckets; the first ``told`` rows, a large bucket's first and last so far, were given before."""
        shingle, class_, place = rows
        starts = group_starts([shingle])
        size = np.diff(starts, append=len(shingle))
        if told:
            size[0] = max(size[0], SMALL + 1)
        at, size = np.repeat(starts, np.diff(starts, append=len(shingle))), np.repeat(size, np.diff(starts, append=len(shingle)))
        row = np.arange(len(shingle))
        large = (size > SMALL) & (row >= told)
        left, right = [], []
        for step in range(1, SMALL):
            of = row[(row >= told) & (row - at >= step)]
            left.append(of - step)
            right.append(of)
        of = row[large & (row - at >= SMALL)]
        left.append(at[of])
        right.append(of)
        i, j = np.concatenate(left), np.concatenate(right)
        kept = may_link(place[i], place[j], percent)
        a, b = class_[i[kept]], class_[j[kept]]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        n, m = pairs.shape[1], int(large.sum())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(n, np.int64), shingle[large]]), mask=np.arange(n + m) < n),
                pa.array(np.concatenate([pairs[0], class_[large]])),
                pa.array(np.concatenate([pairs[1], place[large]])),
            ],
            ["shingle", "a", "b"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, told = np.zeros((3, 0), np.int64), 0  # of the last bucket, which may go on
        for batch in batches:
            rows = np.stack([batch[c].to_numpy() for c in ("shingle", "class", "place")])
            rows = np.concatenate([rest, rows], axis=1)
            if not rows.shape[1]:
                continue
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            rows = rows[:, new]
            last = int(group_starts([rows[0]])[-1])
            if rows.shape[1] - last <= SMALL and not (told and last == 0):
                rows, rest, goes_on = rows[:, :last], rows[:, last:], 0
            else:
                rest, goes_on = rows[:, [last, -1]], 2
            if rows.shape[1]:
                yield pairs_of(rows, told)
            told = goes_on
        if rest.shape[1] and not told:
            yield pairs_of(rest, 0)

    return (
        entries.repartition("shingle")
        .sortWithinPartitions("shingle", F.xxhash64("shingle", "class"), "class")
        .mapInArrow(run, "shingle long, a long, b long")
    )


def _by_bound(pairs: DataFrame, classes: DataFrame, percent: int, point: str = "point") -> DataFrame:
    """The pairs ``(a, b)`` whose points allow them to be linked: the sum of coordinate minima bounds the overlap.

    A pair of which one has no fine point passes that bound.
    """
    a, b = (
        classes.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col(point).alias(f"point_{x}"))
        for x in "ab"
    )
    sized = pairs.join(a, "a").join(b, "b")
    minima = F.aggregate(F.zip_with("point_a", "point_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    passes = (100 + percent) * minima >= percent * (F.col("n_a") + F.col("n_b"))
    open_ = (F.size("point_a") == 0) | (F.size("point_b") == 0)
    return sized.where(F.when(open_, True).otherwise(passes)).select("a", "b")


def _between_parts(members: DataFrame, classes: DataFrame, parts: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Pairs of classes in one large bucket that aren't connected yet and that their places and points allow to be linked.

    Only buckets with several parts are looked at. Each is cut into blocks, and
    each pair of its blocks is a group: a small tree of leaves with the largest
    coordinates and the smallest size of their points. Leaves whose summed
    minima can't reach the bound are skipped with all their pairs.
    """
    part = F.coalesce("component", "class")
    placed = classes.join(parts, F.col("class") == F.col("node"), "left").select("class", "n", "point", part.alias("part"))
    rows = members.join(placed.select("class", "part"), "class")
    open_ = rows.groupBy("shingle").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high")
    rows = members.join(materialize(open_.select("shingle"), "open-buckets"), "shingle", "left_semi")
    counts = rows.groupBy("shingle").agg(F.ceil(F.count("*") / block_rows).alias("blocks")).where("blocks > 1")
    counts = materialize(counts, "large-buckets").withColumnRenamed("shingle", "_large")
    dealt = (
        rows.join(placed, "class")
        .join(counts, F.col("shingle") == F.col("_large"), "left")
        .select("*", F.coalesce("blocks", F.lit(1)).alias("_n"))
        .select("*", F.pmod(F.xxhash64("class"), "_n").alias("block"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("partner"))
    )
    dealt = dealt.select(
        "shingle",
        F.least("block", "partner").alias("low"),
        F.greatest("block", "partner").alias("high"),
        "block",
        "class",
        "place",
        "part",
        "n",
        "point",
    )

    def pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["shingle", "low", "high"]):
            found_a, found_b = [], []
            columns = [table[c].to_numpy() for c in ("class", "place", "part", "n", "block")]
            low, high = table["low"].to_numpy(), table["high"].to_numpy()
            points = table["point"].combine_chunks().flatten().to_numpy().reshape(-1, DIMENSIONS)
            for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
                class_, place, part_, n, block = (c[start:end] for c in columns)
                point = points[start:end]
                left = np.flatnonzero(block == low[start])
                right = left if low[start] == high[start] else np.flatnonzero(block == high[start])
                folded = point.reshape(len(point), -1, TREE_DIMENSIONS).sum(axis=1)
                for i, j in tree_pairs(n, folded, left, right, percent):
                    apart = (part_[i] != part_[j]) & may_link(place[i], place[j], percent)
                    i, j = i[apart], j[apart]
                    apart = bound_passes(np.minimum(point[i], point[j]).sum(axis=1), n[i], n[j], percent)
                    found_a.append(class_[i[apart]])
                    found_b.append(class_[j[apart]])
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return (
        dealt.repartition("shingle", "low", "high")
        .sortWithinPartitions("shingle", "low", "high")
        .mapInArrow(pair, "a long, b long")
        .distinct()
    )


def tree_pairs(
    n: np.ndarray, point: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, one of ``left`` and one of ``right``, whose summed coordinate minima reach the bound."""

    def leaves(rows: np.ndarray) -> list[np.ndarray]:
        # Sort by size, then tile by the coordinate that varies most among rows of similar size.
        rows = rows[np.argsort(n[rows], kind="stable")]
        out = []
        for at in range(0, len(rows), LEAF * LEAF):
            tile = rows[at : at + LEAF * LEAF]
            tile = tile[np.argsort(point[tile, int(point[tile].var(axis=0).argmax())], kind="stable")]
            out += [tile[i : i + LEAF] for i in range(0, len(tile), LEAF)]
        return out

    trees = [leaves(left)]
    trees.append(trees[0] if right is left else leaves(right))
    top = [np.array([point[x].max(axis=0) for x in t]) for t in trees]
    small = [np.array([n[x].min() for x in t]) for t in trees]
    for i, rows in enumerate(trees[0]):
        minima = np.minimum(top[0][i], top[1]).sum(axis=1)
        open_ = bound_passes(minima, small[0][i], small[1], percent)
        if right is left:
            open_[:i] = False
        for j in np.flatnonzero(open_):
            others = trees[1][j]
            minima = np.minimum(point[rows][:, None], point[others][None]).sum(axis=2)
            a, b = np.nonzero(bound_passes(minima, n[rows][:, None], n[others][None], percent))
            a, b = rows[a], others[b]
            if right is left and i == j:
                a, b = a[a < b], b[a < b]
            yield a, b


# -- verification ------------------------------------------------------------


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(class, text)`` of one document for each wanted class.

    The wanted ids are written first, so Spark knows their size: a short list is
    broadcast and the documents aren't shuffled.
    """
    reps = classes.join(wanted, "class", "left_semi").select(F.col("rep").alias("_rep"), "class")
    found = docs.join(materialize(reps, "wanted"), F.col("id") == F.col("_rep")).select("class", "text")

    def of_class(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                same = shingle_sets(some["text"]).classes() == some["class"].to_numpy()
                yield some.filter(pa.array(same))

    # Rows that share an id may have different texts.
    return found.mapInArrow(of_class, "class long, text string")


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links: those that pass the fine bound and then the comparison of whole texts."""
    classes = materialize(classes.join(_of_pairs(pairs), "class", "left_semi"), "classes-of-pairs")
    pairs = materialize(_by_bound(pairs, classes, percent, "fine"), "pairs")
    texts = materialize(_texts(docs, classes, _of_pairs(pairs)), "texts")
    return materialize(_verified(pairs, texts, percent), "links")


def _of_pairs(pairs: DataFrame) -> DataFrame:
    """The classes that a table of pairs names, written so that Spark knows how many they are."""
    return materialize(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "classes-named")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, per_group: int = 256) -> DataFrame:
    """The pairs whose texts' shingle sets reach the similarity, by exact intersection.

    Pairs are grouped by their first class, whose set is built once; the pairs
    of a hub are dealt over so many groups that each holds about ``per_group``.
    """
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / per_group).alias("groups"))
    of_hub = hubs.join(texts, F.col("a") == F.col("class")).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), F.lit(None).cast("long").alias("b"), "text"
    )
    others = (
        pairs.join(hubs, "a")
        .join(texts, F.col("b") == F.col("class"))
        .select("a", F.pmod(F.xxhash64("b"), "groups").alias("group"), "b", "text")
    )

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(some["text"])
                a, b = some["a"].to_numpy(), some["b"]
                is_hub = np.asarray(b.is_null())
                linked = np.zeros(len(a), bool)
                borders = np.flatnonzero(is_hub)
                for start, end in zip([0, *borders], [*borders, len(a)], strict=True):
                    if start in borders:
                        hub = sets.hash[sets.start[start] : sets.start[start + 1]]
                        start += 1
                    if start >= end or not len(hub):
                        continue
                    mine = sets.hash[sets.start[start] : sets.start[end]]
                    there = hub[np.minimum(np.searchsorted(hub, mine), len(hub) - 1)] == mine
                    total = np.concatenate([[0], np.cumsum(there)])
                    cut = sets.start[start : end + 1] - sets.start[start]
                    shared = total[cut[1:]] - total[cut[:-1]]
                    union = len(hub) + sets.size[start:end] - shared
                    linked[start:end] = 100 * shared >= percent * union
                yield pa.RecordBatch.from_arrays([some["a"], b], ["a", "b"]).filter(pa.array(linked))

    return (
        of_hub.unionByName(others)
        .repartition("a", "group")
        .sortWithinPartitions("a", "group", F.col("b").asc_nulls_first())
        .mapInArrow(verify, "a long, b long")
    )


# -- the operator ------------------------------------------------------------


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, block_rows: int = 1_024
) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row; links are pairs with Jaccard similarity >= ``percent`` %.

    Exact but for collisions of 64-bit hashes. Equal sets are one class. A
    document's point counts its shingles in ``DIMENSIONS`` groups; the sum of
    two points' coordinate minima is at least their overlap, so pairs below the
    bound are never looked at. Points alone can't part a large corpus (unrelated
    documents of like size have like counts), so the index is a forest: a tree
    for each bucket of documents that share one of their first shingles. Pairs
    of large sets meet a second bound, of finer points.

    Small buckets give all their pairs. Each member of a large one first meets
    the bucket's hub and some their neighbours, so a dense group costs about as
    many pairs as members; what isn't connected after that meets in the
    buckets' trees. A pair counts in a bucket only if what follows the shared
    shingle in both sets is enough. Surviving pairs are verified on whole texts.

    Without words, or with NULL text, a row has no shingles and links with
    nothing. Rows that share an id are one document to the components; rows
    with a NULL id link with nothing and have a NULL component. Other columns
    are left out.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    described = materialize(_describe(docs), "documents")
    known = described.where("n > 0 AND id IS NOT NULL")
    classes = materialize(
        known.groupBy("class").agg(F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "point", "fine"))),
        "classes",
    )
    usable = docs.where(F.col("id").isNotNull())
    buckets = materialize(_buckets(_entries(usable, _frequent_groups(described), percent), percent), "buckets")
    pairs = materialize(_by_bound(buckets.where("shingle IS NULL").select("a", "b").distinct(), classes, percent), "first-pairs")
    members = buckets.where("shingle IS NOT NULL").select("shingle", F.col("a").alias("class"), F.col("b").alias("place"))
    links = _linked(usable, classes, pairs, percent)
    parts = components(links)
    more = materialize(_between_parts(members, classes, parts, percent, block_rows).join(pairs, ["a", "b"], "left_anti"), "tree-pairs")
    if not more.isEmpty():
        found = _linked(usable, classes, more, percent)
        if not found.isEmpty():
            parts = components(links.unionByName(found))
    placed = classes.join(parts, F.col("class") == F.col("node"), "left").select(
        "class", "rep", F.coalesce("component", "class").alias("part")
    )
    lowest = placed.groupBy("part").agg(F.min("rep").alias("component_id"))
    of_class = placed.join(lowest, "part").select(F.col("class").alias("_class"), "component_id")
    rows = described.where("n >= 0").select("id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class"))
    rows = rows.join(of_class, F.col("class") == F.col("_class"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
