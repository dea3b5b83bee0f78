"""Best-fit packing: length patterns fitted by non-negative least squares, residuals by best fit."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardstar.llm.common import materialize
from yardstar.llm.text import SPACE, buffer, slices, span_hash

SLICE_BYTES = 1 << 19  # of text in one pass: each takes about a hundred times as much in arrays


class Packed(NamedTuple):
    tokens: DataFrame  # id, piece, start, length, ids, part, row: one row for each piece
    places: DataFrame  # part, row, sequence_id, offset


# -- tokens ------------------------------------------------------------------


class Encoder:
    """Ids of whole batches of texts.

    The pre-tokenizer of a byte-level BPE vocabulary always splits at some
    places: before a single space that a word follows (the space goes with the
    word), between an ASCII word and punctuation other than an apostrophe, and
    around a line end between ASCII characters. So a batch is cut there with
    numpy, and as most stretches repeat, only distinct ones are encoded, many
    joined into one text; all ids are then gathered from a store. Stretches
    seen before come from the store, which starts anew when it is full.

    With ``added_tokens``, the literal text of a token added to the vocabulary
    is that token, as the tokenizer has it by default: what stands before and
    behind it is cut as texts of their own. Without, it is plain text.
    """

    # All of ASCII white space and the first bytes of the multi-byte characters that count as white space.
    MAYBE_SPACE = SPACE.copy()
    MAYBE_SPACE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
    WORD = np.zeros(256, bool)
    WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    SIGN = np.zeros(256, bool)
    SIGN[[c for c in range(0x21, 0x7F) if c != 0x27]] = True
    SIGN &= ~WORD

    def __init__(self, path: str, most_kept: int = 1_500_000, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token) if all(c in byte_of for c in token) else len(token.encode())
        self.most_kept = most_kept
        added = self.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        self.added = {t.content.encode(): i for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.literal = re.compile(b"|".join(map(re.escape, longest_first))) if added else None
        self.clear()

    def clear(self) -> None:
        # Sorted hashes of stretches with the place of their ids in the store: a large table, and a small one of the
        # latest that is merged into it now and then.
        nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.known = [nothing, nothing]
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0
        for text, i in self.added.items():
            key = span_hash(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
            self.store[self.used] = i
            self._keep(key, np.array([self.used]), np.array([1]))
            self.used += 1

    def literals(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each added token in the texts."""
        found: list[tuple[int, int]] = []
        raw, at = data.tobytes() if self.literal else b"", 0
        while self.literal and (match := self.literal.search(raw, at)):
            border = int(offsets[np.searchsorted(offsets, match.start(), "right")])
            # One that runs into the next text is none, but a shorter one may stand there.
            if match := self.literal.search(raw, match.start(), border):
                found.append(match.span())
            at = match.end() if match else border
        spans = np.array(found, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data) + 1, bool)
        before, here = data[:-1], data[1:]
        line = here == 0x0A
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True  # what follows there is another text
        cut[1:-1] = self.SIGN[here] & self.WORD[before]
        cut[1:-1] |= line & (self.SIGN | self.WORD)[before]
        # The last line end of a run of white space is a piece of its own if a word follows.
        ends = (before == 0x0A) & (self.SIGN | self.WORD)[here] & ~begins[1:-1]
        cut[1:-1] |= ends
        cut[:-2] |= ends
        cut[1:-2] |= (data[1:-1] == 0x20) & ~self.MAYBE_SPACE[data[2:]] & ~begins[2:-1]
        cut[offsets[offsets < len(data)]] = True
        return np.flatnonzero(cut[:-1])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the offset of each text in it."""
        data, offsets = buffer(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        literal, behind = self.literals(data, offsets)
        start = self.cuts(data, np.union1d(offsets, np.concatenate([literal, behind])))
        if len(literal):
            # Nothing is cut inside a literal.
            at = np.searchsorted(literal, start, "right") - 1
            start = start[(at < 0) | (start == literal[at]) | (start >= behind[at])]
        end = np.append(start[1:], len(data))
        keys, first, which = np.unique(span_hash(data, start, end), return_index=True, return_inverse=True)
        if sum(len(k[0]) for k in self.known) > self.most_kept:
            self.clear()
        at, many = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        for known, its_at, its_many in self.known:
            if len(known):
                found = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                same = known[found] == keys
                at[same], many[same] = its_at[found[same]], its_many[found[same]]
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new], many[new] = self._learn(data, start[first[new]], end[first[new]])
            self._keep(keys[new], at[new], many[new])
        at, many = at[which], many[which]
        total = np.concatenate([[0], np.cumsum(many)])
        ids = self.store[np.repeat(at - total[:-1], many) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, offsets)]

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode stretches into the store; place and number of the ids of each."""
        # Where a space and a word begin the stretch, nothing in front can change it. Others are encoded alone.
        second = data[np.minimum(start + 1, len(data) - 1)]
        joins = (data[start] == 0x20) & (end - start > 1) & ~self.MAYBE_SPACE[second]
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        n_joined = int(joins.sum())
        start, end = start[order], end[order]
        width = end - start
        stop = np.cumsum(width)
        gathered = data[np.repeat(start - (stop - width), width) + np.arange(stop[-1])].tobytes()
        borders = [*range(0, n_joined, 64), *range(n_joined, len(start))]
        places = [0, *stop.tolist()]
        texts = [gathered[places[i] : places[j]].decode() for i, j in zip(borders, [*borders[1:], len(start)], strict=True)]
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in got])
        last = np.searchsorted(np.cumsum(self.width[ids]), stop) + 1
        many = np.diff(last, prepend=0)
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + len(ids)] = ids
        out_at, out_many = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        out_at[order], out_many[order] = self.used + last - many, many
        self.used += len(ids)
        return out_at, out_many

    def _keep(self, keys: np.ndarray, at: np.ndarray, many: np.ndarray) -> None:
        new = (keys, at, many.astype(np.int32))
        self.known[1] = _merged(self.known[1], new)
        if len(self.known[1][0]) > 50_000 + len(self.known[0][0]) // 4:
            self.known = [_merged(*self.known), tuple(x[:0] for x in new)]


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    both = [np.concatenate(x) for x in zip(a, b, strict=True)]
    order = np.argsort(both[0], kind="stable")
    return tuple(x[order] for x in both)


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker: tasks that follow each other share its store."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        _encoders.clear()
        _encoders[path] = Encoder(path, added_tokens=True)
    return _encoders[path]


def _byte_alphabet() -> set[str]:
    """The characters by which a byte-level vocabulary writes single bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b) for b in plain} | {chr(0x100 + i) for i in range(256 - len(plain))}


def tokenize(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``(id, piece, start, length, ids, part, row)``.

    A document is the ids of its whole text, as the tokenizer gives them by
    default without the tokens it would put around it, and ``end_id``. Only longer ones
    are cut, and then the first piece takes what is over, so that all others
    are full. ``part`` and ``row`` number the task and its pieces.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                ids, at = encoder.encode(some["text"])
                lengths = np.diff(at) + 1
                # The end id goes behind each document: all ids move by the number of documents before them.
                whole = np.full(len(ids) + len(lengths), end_id, np.uint32)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths - 1)] = ids
                doc_at = np.cumsum(lengths) - lengths
                n_pieces = -(-lengths // capacity)
                doc = np.repeat(np.arange(len(lengths)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = lengths - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                cuts = np.append(doc_at[doc] + start, len(whole)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        some["id"].take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(whole.view(np.int32))),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(row + np.arange(len(doc))),
                    ],
                    ["id", "piece", "start", "length", "ids", "part", "row"],
                )
                row += len(doc)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        pieces, f"id {id_type}, piece int, start long, length long, ids array<int>, part int, row long"
    )


# -- the plan, from the histogram of lengths ---------------------------------


class Run(NamedTuple):
    """``count`` pieces of one length, one in each of as many sequences from ``sequence`` on, at ``offset``."""

    length: int
    count: int
    sequence: int
    offset: int


class Bins:
    """Sequences under construction, kept as runs of equal free space."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[Run] = []
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free ids: runs of (first, count)
        self.levels: list[int] = []  # the free spaces that have runs, sorted
        self.next = 0

    def put(self, free: int, first: int, count: int) -> None:
        if count and free:
            if not self.free[free]:
                insort(self.levels, free)
            self.free[free].append((first, count))

    def pop(self, free: int) -> tuple[int, int]:
        got = self.free[free].pop()
        if not self.free[free]:
            self.levels.remove(free)
        return got

    def place(self, length: int, count: int, first: int, free: int) -> None:
        self.runs.append(Run(length, count, first, self.capacity - free))

    def open(self, count: int) -> int:
        first, self.next = self.next, self.next + count
        return first

    def best_fit(self, length: int, count: int) -> None:
        """Put pieces one by one where the least space is left, in new sequences if none has room."""
        while count:
            i = bisect_left(self.levels, length)
            if i == len(self.levels):
                each = self.capacity // length
                full, over = divmod(count, each)
                for n, sequences in ((each, full), (over, 1)):
                    if n and sequences:
                        first = self.open(sequences)
                        for k in range(n):
                            self.place(length, sequences, first, self.capacity - k * length)
                        self.put(self.capacity - n * length, first, sequences)
                return
            free = self.levels[i]
            first, n = self.pop(free)
            k = min(n, count)
            self.place(length, k, first, free)
            self.put(free - length, first, k)
            self.put(free, first + k, n - k)
            count -= k


def patterns(bins: int, most: int) -> list[tuple[int, ...]]:
    """All ways to fill ``bins`` units with two to ``most`` lengths, the longest first."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], left: int) -> None:
        if left == 0:
            if len(head) > 1:
                out.append(head)
        elif len(head) < most:
            for n in range(min(left, head[-1] if head else bins), 0, -1):
                if n * (most - len(head)) >= left:
                    extend((*head, n), left - n)

    extend((), bins)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|``, by active sets."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = 0
        best = int(gradient.argmax())
        if gradient[best] <= 1e-9 * max(1.0, float(np.abs(b).max(initial=0))):
            break
        active[best] = True
        while True:
            solved = np.zeros_like(x)
            solved[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if (solved[active] > 0).all():
                x = solved
                break
            low = active & (solved <= 0)
            step = (x[low] / np.maximum(x[low] - solved[low], 1e-300)).min()
            x = x + step * (solved - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], capacity: int, units: int = 64, most: int = 3) -> list[Run]:
    """Where the pieces of each length go, as runs; works on counts, so its cost doesn't depend on them.

    Lengths are rounded up to ``capacity / units``. All patterns of two to
    ``most`` documents that fill a sequence are fitted to the histogram by
    non-negative least squares with relative errors, rounded down, and filled
    with actual lengths, the longest of each class first. What is left, from
    the longest down, goes where it fits best: into the space left over in the
    patterns' sequences or into new ones. Full pieces have sequences of their own.
    """
    bins = Bins(capacity)
    left = {n: c for n, c in histogram.items() if c}
    if full := left.pop(capacity, 0):
        bins.place(capacity, full, bins.open(full), capacity)
    unit = -(-capacity // units)
    units = capacity // unit
    classes: dict[int, list[int]] = defaultdict(list)
    for n in sorted(left):
        classes[-(-n // unit)].append(n)
    counts = np.array([sum(left[n] for n in classes.get(c, ())) for c in range(units + 1)], np.float64)
    known = [p for p in patterns(units, most) if all(counts[c] for c in p)]
    if known:
        a = np.zeros((units + 1, len(known)))
        for j, p in enumerate(known):
            for c in p:
                a[c, j] += 1
        weight = 1 / np.sqrt(np.maximum(counts, 1))
        fitted = nonnegative_least_squares(a * weight[:, None], counts * weight)
        room = counts.astype(np.int64)
        for j in np.argsort(-fitted, kind="stable"):
            p = known[j]
            repeat = min(int(fitted[j]), *(int(room[c]) // p.count(c) for c in p))
            if repeat < 1:
                continue
            for c in p:
                room[c] -= repeat
            _fill(bins, p, repeat, classes, left)
    for n in sorted(left, reverse=True):
        bins.best_fit(n, left[n])
    return bins.runs


def _fill(bins: Bins, pattern: tuple[int, ...], repeat: int, classes: dict[int, list[int]], left: dict[int, int]) -> None:
    """Open ``repeat`` sequences and give each a piece of every class of the pattern.

    The last piece of a sequence is the longest that fits, which makes up for
    the rounding of the lengths; if none of its class or above does, the rest
    of the space is left to the best fit.
    """
    spans = [(bins.open(repeat), repeat, bins.capacity)]
    for i, c in enumerate(pattern):
        new = []
        for first, count, free in spans:
            while count:
                if i + 1 < len(pattern):
                    of, at = c, len(classes[c]) - 1
                else:
                    of, at = _longest(classes, c, free, max(classes))
                if at < 0:
                    new.append((first, count, free))
                    break
                n = classes[of][at]
                k = min(count, left[n])
                bins.place(n, k, first, free)
                new.append((first, k, free - n))
                first, count = first + k, count - k
                left[n] -= k
                if not left[n]:
                    del left[n]
                    classes[of].pop(at)
        spans = new
    for first, count, free in spans:
        bins.put(free, first, count)


def _longest(classes: dict[int, list[int]], lowest: int, free: int, highest: int) -> tuple[int, int]:
    """Class and place of the longest length up to ``free`` in the classes from ``lowest`` on; -1 if there is none."""
    for c in range(highest, lowest - 1, -1):
        if lengths := classes.get(c):
            at = bisect_right(lengths, free) - 1
            if at >= 0:
                return c, at
    return lowest, -1


# -- the operator ------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
) -> Packed:
    """Pack the ids of all documents into sequences of at most ``capacity``, whole pieces without gaps.

    The ids are written to the shared folder once. Only the histogram of piece
    lengths (at most ``capacity`` rows) reaches the driver, which plans runs of
    equal sequences from it. A piece's rank among those of its length is its
    rank in its task plus the prefix sum over the tasks before, so the many
    full pieces are never brought together; the rank picks its run and place.

    NULL text is empty and packs as the end id alone. Rows that repeat an id,
    NULL included, are packed one by one. No rows give no sequences.
    """
    tokens = materialize(tokenize(docs, tokenizer_path, id_col, text_col, capacity, end_id), "tokens")
    counts = materialize(tokens.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(plan(histogram, capacity), key=lambda r: r.length)
    count = np.array([r.count for r in runs], np.int64)
    run_start = np.cumsum(count) - count  # rank over all pieces, ordered by length
    length_start = np.zeros(capacity + 1, np.int64)
    for n in histogram:
        length_start[n] = sum(c for m, c in histogram.items() if m < n)
    sequence, offset = (np.array([getattr(r, f) for r in runs], np.int64) for f in ("sequence", "offset"))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    in_task = Window.partitionBy("part", "length").orderBy("row")
    ranked = (
        tokens.select("part", "row", "length", (F.row_number().over(in_task) - 1).alias("rank"))
        .join(offsets, ["part", "length"])
        .select("part", "row", "length", (F.col("rank") + F.col("earlier")).alias("rank"))
    )

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = length_start[b["length"].to_numpy()] + b["rank"].to_numpy()
            run = np.searchsorted(run_start, rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b["part"], b["row"], pa.array(sequence[run] + rank - run_start[run]), pa.array(offset[run])],
                ["part", "row", "sequence_id", "offset"],
            )

    places = ranked.mapInArrow(assign, "part int, row long, sequence_id long, offset long")
    return Packed(tokens, places)


def piece_table(packed: Packed, id_col: str = "doc_id") -> DataFrame:
    """Every piece with its place and the CRC-32 of its ids, instead of the ids."""
    from zlib import crc32

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["ids"]
            cut = ids.offsets.to_numpy()
            data = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [crc32(data[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
            columns = {c: b[c] for c in ("id", "piece", "start", "length", "part", "row")}
            yield pa.RecordBatch.from_pydict(columns | {"ids_crc32": pa.array(crc, pa.int64())})

    id_type = packed.tokens.schema["id"].dataType.simpleString()
    digests = packed.tokens.mapInArrow(
        digest, f"id {id_type}, piece int, start long, length long, part int, row long, ids_crc32 long"
    )
    return digests.join(packed.places, ["part", "row"]).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
