"""Quality classifier: a linear support vector machine over n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstar.llm.common import numbered
from yardstar.llm.text import LOWER, SPACE, buffer, mix, slices, words

BITS = 18
FEATURES = 1 << BITS

# Shapes: letters by case, digits, signs as they are, white space as one blank.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[LOWER != SHAPE] = ord("A")
SHAPE[ord("a") : ord("z") + 1] = ord("a")
SHAPE[0x80:] = ord("a")
SHAPE[ord("0") : ord("9") + 1] = ord("0")
SHAPE[SPACE] = 0x20
REPEATED = np.uint64(0x5EED)


class Model(NamedTuple):
    """``score = sigmoid(slope * (w . x / |x| + bias) + shift)`` for the indicators x scaled by the ratios."""

    weight: np.ndarray  # of each indicator: its log-count ratio times its coefficient
    square: np.ndarray  # squared log-count ratio of each indicator
    bias: float
    slope: float
    shift: float

    def score(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        norm = np.sqrt(np.bincount(doc, self.square[feature], n))
        margin = np.bincount(doc, self.weight[feature], n) / np.where(norm > 0, norm, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(doc, feature)`` of every distinct n-gram of each text, hashed to ``FEATURES`` numbers.

    Three bytes, and one to three word shapes: a word's shape are its
    characters' classes without repetition, or a mark if the word is the same
    as the one before it.
    """
    data, offsets = buffer(texts)
    n = len(texts)
    there = np.zeros(n * FEATURES, bool)
    if len(data) >= 3:
        d = data.astype(np.uint32)
        gram = ((d[:-2] << 16) | (d[1:-1] << 8) | d[2:]) * np.uint32(0x9E3779B1) >> np.uint32(33 - BITS)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        whole = doc[:-2] == doc[2:]
        there[(doc[:-2][whole] << BITS) | gram[whole]] = True
    shape = SHAPE[data]
    kept = np.ones(len(data), bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[offsets[offsets < len(data)]] = True
    total = np.concatenate([[0], np.cumsum(kept)])
    found, shapes = words(data, offsets), words(shape[kept], total[offsets])
    code = shapes.hash.copy()
    same = (found.hash[1:] == found.hash[:-1]) & (found.text[1:] == found.text[:-1])
    code[1:][same] = REPEATED
    gram = code
    for size in (1, 2, 3):
        if size > 1:
            gram = mix(gram[:-1] * np.uint64(31)) + code[size - 1 :]
        of = found.text[: len(gram)]
        whole = of == found.text[size - 1 :]
        number = (mix(gram + np.uint64(size))[whole] >> np.uint64(65 - BITS)).astype(np.int64) | (1 << (BITS - 1))
        there[(of[whole] << BITS) | number] = True
    at = np.flatnonzero(there)
    return at >> BITS, at & (FEATURES - 1)


def _few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches small enough for a table of flags for each text and feature."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            yield from slices(batch.slice(at, 128), "text", 2 << 20)


# -- fitting, on a bounded sample --------------------------------------------


def log_count_ratios(feature: np.ndarray, positive: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log ratio of each indicator's share in the positive and in the negative class."""
    p = alpha + np.bincount(feature[positive], minlength=FEATURES)
    q = alpha + np.bincount(feature[~positive], minlength=FEATURES)
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 1
) -> tuple[np.ndarray, float]:
    """Coefficients and bias of the linear hinge-loss model, one dual variable at a time in random order."""
    w, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            gradient = y[i] * (w[at] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / (x @ x + 1), 0.0), c)
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * x
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def _fit(docs: list[np.ndarray], label: np.ndarray) -> Model:
    feature = np.concatenate(docs)
    ratio = log_count_ratios(feature, np.repeat(label == 1, [len(d) for d in docs]))
    rows = []
    for d in docs:
        x = ratio[d]
        rows.append((d, x / (np.sqrt(x @ x) or 1.0)))
    w, bias = dual_coordinate_descent(rows, np.where(label == 1, 1.0, -1.0))
    return Model(ratio * w, ratio * ratio, bias, 1.0, 0.0)


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through held-out margins, by Newton steps on smoothed labels."""
    ones = int(label.sum())
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = x.T @ (x * np.maximum(p * (1 - p), 1e-9)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * b)
        b = b + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return float(b[0]), float(b[1])


def fit(docs: list[np.ndarray], label: np.ndarray, folds: int = 3) -> Model:
    """Fit on all rows; the margins that the score's scale is fitted to come from models that haven't seen their rows."""
    if len(set(label.tolist())) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(docs)) % folds
    margin, known = np.zeros(len(docs)), np.zeros(len(docs), bool)
    for f in range(folds):
        seen, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        if len(rest) and len(set(label[seen].tolist())) == 2:
            model = _fit([docs[i] for i in seen], label[seen])
            for i in rest:
                score = model.score(np.zeros(len(docs[i]), np.int64), docs[i], 1)[0]
                margin[i], known[i] = np.log(score / (1 - score)), True
    model = _fit(docs, label)
    slope, shift = _calibrate(margin[known], label[known]) if known.any() else (1.0, 0.0)
    return model._replace(slope=slope, shift=shift)


def is_held_out(doc_id: str | Column) -> Column:
    """Rows never learnt from: CRC-32 of the id as text, modulo 4, is 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 6_000,
) -> Model:
    """Fit the classifier on at most ``sample_rows`` labelled rows, those with the smallest hash of their id.

    This bound is what keeps the fit in one place. Held-out rows, NULL labels
    and ids without a document are left out; an id labelled twice takes the
    lower label. Of documents that repeat an id one is learnt from, the one
    whose text has the smallest hash. With one class alone every text scores its smoothed share.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    sample = (
        known.groupBy(F.col(id_col).alias("_id"))
        .agg((F.min(label_col) == 1).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )
    chosen = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), F.col("_doc") == F.col("_id")  # bounded by sample_rows
    )
    chosen = chosen.groupBy("_id", "_label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            doc, feature = indicators(b["text"])
            cut = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            features = pa.ListArray.from_arrays(pa.array(cut), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b["order"], b["label"], features], ["order", "label", "features"])

    found = chosen.select(F.xxhash64("_id").alias("order"), F.col("_label").alias("label"), "text").mapInArrow(
        featurise, "order long, label int, features array<int>"
    )
    rows = found.toArrow().sort_by("order")  # one row for each id of the sample
    if not rows.num_rows:
        return fit([], np.zeros(0, np.int64))
    features = rows["features"].combine_chunks()
    cut = features.offsets.to_numpy()
    numbers = features.values.to_numpy()
    return fit([numbers[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)], rows["label"].to_numpy())


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text: 0 to 1, higher where label 1 is likelier.

    A NULL or empty text has no indicators and scores by the bias alone. One
    pass without a shuffle; all other columns are kept as they are, but one
    named like the score is replaced.
    """
    docs = docs.drop(score_col)
    plain, number = numbered(docs)
    names = list(number.values())
    plain = plain.select("*", F.col(number[text_col]).alias("text"))

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            found = model.score(*indicators(b["text"]), b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found)], [*names, "score"])

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True))
    return plain.mapInArrow(rate, f"{schema}, score double").toDF(*docs.columns, score_col)


def predict(score_col: str = "score", threshold: float = 0.7) -> Column:
    return (F.col(score_col) >= threshold).cast("int")
