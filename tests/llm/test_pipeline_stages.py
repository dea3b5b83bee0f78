"""Each stage of the pipeline against brute force on what the stage before kept, and the run as a whole."""

from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from conftest import SF
from test_operators import WORD, Union, brute_sets, brute_targets

import corpus_pipeline
from yardstar.llm import packing, queries
from yardstar.llm.common import materialize


def test_stages_hold_few_texts_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(name)
    corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert int(spark.conf.get(name)) == corpus_pipeline.BATCH_ROWS < 10_000
    assert packing.SLICE_BYTES <= 1 << 19


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        kept.append(docs.collect())
    given, good, lined, single, mixed, packed = kept

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    by_id = {r.doc_id: r for r in given}
    assert all(r == by_id[r.doc_id] for r in good)
    passed = {r.doc_id for r in good}
    right = [(i in passed) == (q == 1) for i, q in labels.items() if i in by_id]
    assert sum(right) / len(right) > 0.95

    pages, with_line = Counter(r.source for r in good), Counter()
    for r in good:
        with_line.update({(r.source, x.strip(" \t\r\f\v")) for x in r.text.split("\n")})
    want = {}
    for r in good:
        lines = [
            x
            for x in r.text.split("\n")
            if not x.strip(" \t\r\f\v")
            or with_line[(r.source, x.strip(" \t\r\f\v"))] < 5
            or with_line[(r.source, x.strip(" \t\r\f\v"))] <= 0.05 * pages[r.source]
        ]
        want[r.doc_id] = "\n".join(lines)
    assert {r.doc_id: r.text for r in lined} == want
    assert all(r.n_chars == len(r.text) for r in lined if r.text != by_id[r.doc_id].text)

    rows = [(r.doc_id, r.text) for r in lined]
    sets, union = brute_sets(rows), Union([k for k, _ in rows])
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= 80 * len(s | sets[j]):
                union.join(rows[i][0], rows[j][0])
    assert sorted(r.doc_id for r in single) == sorted(k for k, _ in rows if union.find(k) == k)

    sizes, taken = defaultdict(int), defaultdict(int)
    for r in single:
        sizes[r.source] += len(WORD.findall(r.text))
    texts = {r.doc_id: r.text for r in single}
    for r in mixed:
        assert texts[r.doc_id].startswith(r.text)
        taken[r.source] += len(WORD.findall(r.text))
    assert all(abs(taken[s] - t) <= 0.5001 for s, t in brute_targets(sizes).items())

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed:
        ids = np.array([*plain.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for piece, end in enumerate(range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)):
            want[(r.doc_id, piece, start, end - start, crc32(ids[start:end].tobytes()))] += 1
            start = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048

    again = queries.QUERIES["pipeline"](spark, SF).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[k] for k in key) for r in again) == want


def test_near_duplicates_are_rows_not_ids(spark):
    words = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcdefg"]
    a, b, c, d, e, f, g = words
    rows = [(1, a), (2, b), (5, c), (5, d), (6, a + " more"), (6, e), (7, f), (7, f), (8, ""), (8, ""), (8, None), (9, "")]
    rows += [(None, a), (None, a), (None, g)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, df.repartition(3), SF)
    want = [(1, a), (2, b), (5, c), (5, d), (6, e), (7, f), (8, ""), (8, None), (9, ""), (None, a), (None, a), (None, g)]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_columns_named_like_working_columns_pass_through(spark, tmp_path):
    rows = [(i, "good words here " * 5 + str(i % 7) if i % 2 else "bad !! " * 9, "x", i, -i) for i in range(40)]
    docs = spark.createDataFrame(rows + [rows[1]], "doc_id long, text string, source string, _score int, _row long")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (corpus_pipeline.quality_classifier, corpus_pipeline.near_duplicates):
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert got.count() > 0 and all((r["_score"], r["_row"]) == (r.doc_id, -r.doc_id) for r in got.collect())
