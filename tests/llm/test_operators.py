"""The operators against brute force on small tables with NULLs, empty and long texts, ties, copies and odd columns."""

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from yardstar.llm import html, licenses, line_dedup, mixing, near_vectors, ngram_join, packing, quality, topk, url_rules
from yardstar.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def made_up_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# -- connected components -----------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (300, 299), (299, 300)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(40)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = Union({n for e in edges for n in e})
    for a, b in edges:
        want.join(a, b)
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: want.find(n) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 embeddings ---------------------------------------------------------------


def brute_links(rows, threshold=0.9):
    good = []
    for i, (key, v) in enumerate(rows):
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x = x / np.abs(x).max()
            good.append((i, x / np.sqrt((x * x).sum())))
    return {(i, j) for i, x in good for j, y in good if i != j and len(x) == len(y) and x @ y >= threshold}


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(300)]
    base = rng.standard_normal(16)
    rows += [(1000 + i, (base + 0.05 * rng.standard_normal(16)).tolist()) for i in range(60)]
    rows += [(2000 + i, rows[5][1]) for i in range(30)] + [(2100, [7 * x for x in rows[5][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [math.nan] * 16), (3004, [math.inf] * 16)]
    rows += [(3005, [None] * 16), (3006, [1.0, 2.0]), (3007, [1.0, 2.0]), (None, rows[5][1]), (3008, [1e300] * 16)]
    rows += [(3009, [1e-300] * 16)]
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, rep string, n int")
    got = near_vectors.near_duplicates(df, block_rows=16).collect()
    assert len(got) == len(rows)
    links = brute_links(rows)
    # Every link found is true, and at the threshold used here nearly all are found: exactly so for tight groups.
    by_id = {r.vec_id: r for r in got if r.vec_id is not None}
    count = Counter(i for i, _ in links)
    union = Union({k for k, _ in rows if k is not None})
    for i, j in links:
        union.join(rows[i][0], rows[j][0])
    assert sum(r.n_links for r in got) >= 0.99 * len(links)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            assert by_id[k].n_links <= count[i]
            assert by_id[k].component_id == union.find(k)
            assert by_id[k].kept == (union.find(k) == k)
    [nameless] = [r for r in got if r.vec_id is None]
    assert (nameless.n_links, nameless.component_id, nameless.kept) == (0, None, False)
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


def test_recall_on_the_given_embeddings_with_added_neighbours(spark):
    """Pairs at cosines from the threshold up: at least nine tenths of them are found, and nothing below it."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    for i, (_, v) in enumerate(rows[:400]):
        x = np.array(v) / np.linalg.norm(v)
        away = rng.standard_normal(len(x))
        away -= away @ x * x
        cosine = 0.9 + 0.1 * (i / 400) + 1e-6
        y = cosine * x + math.sqrt(1 - cosine**2) * away / np.linalg.norm(away)
        rows.append((10_000 + i, y.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = near_vectors.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    want = len(brute_links(rows))
    assert want >= 800 and 0.9 * want <= got <= want


@pytest.mark.parametrize("rows", [2_000, 100_000, 1_000_000])
@pytest.mark.parametrize("common", [0.0, 0.69, 0.8])
def test_codes_meet_at_the_threshold_wherever_the_mean_lies(common, rows):
    """Pairs just at cosine 0.9, turned at random and within the data, at the key lengths of large tables."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 64)) * math.sqrt((1 - common) / 64)
    x[:, 0] += math.sqrt(common)
    x = near_vectors.unit_vectors(x)
    codes = near_vectors.learn_codes(x[:2000], rows, 0.9, 0.99)
    x = x[2000:]
    for away in (rng.standard_normal(x.shape), x[::-1]):
        away = near_vectors.unit_vectors(away - (away * x).sum(axis=1, keepdims=True) * x)
        y = 0.9 * x + math.sqrt(0.19) * away
        assert (codes.keys(x) == codes.keys(y)).any(axis=1).mean() > 0.98


def test_codes_of_few_dimensions_and_rows():
    for x in ([[1.0, 2.0]], [[1.0, 2.0], [1.0, 1.0]], [[1.0], [-1.0]], np.random.default_rng(0).standard_normal((50, 2))):
        x = near_vectors.unit_vectors(np.array(x))
        codes = near_vectors.learn_codes(x, 10_000, 0.9, 0.99)
        assert codes.keys(x).shape == (len(x), codes.tables)


# -- 2 n-gram Jaccard join -------------------------------------------------------


def brute_sets(rows):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return sets


@pytest.mark.parametrize("block_rows", [1024, 8])
def test_jaccard_components(spark, block_rows):
    rng = random.Random(11)
    rows = [(i, made_up_text(rng, rng.choice((3, 5, 8, 40, 200, 900)))) for i in range(120)]
    passage = made_up_text(rng, 60)
    rows += [(500 + i, made_up_text(rng, 30) + " " + passage) for i in range(60)]
    rows += [(600 + i, passage + f" tail{i}") for i in range(20)]
    for i, (_, text) in enumerate(rows[:100]):  # copies from nearly equal to just apart
        w = text.split()
        for at in rng.sample(range(len(w)), max(1, len(w) * (i % 10) // 150)):
            w[at] = "changed"
        rows.append((1000 + i, " ".join(w)))
    w = made_up_text(rng, 300).split()
    for i in range(40):  # a chain: neighbours are linked, ends are not
        w[7 * i] = f"step{i}"
        rows.append((2000 + i, " ".join(w)))
    rows += [(3000 + i, rows[3][1].upper() + "\n") for i in range(30)]
    rows += [(4000, None), (4001, ""), (4002, " \t\n"), (4003, "One two"), (4004, "one  TWO"), (4005, "one two x")]
    rows += [(4006, "ä Ä é b c d"), (4007, "ä ä é b c d"), (5, rows[5][1]), (None, rows[6][1]), (4008, "a " * 3000)]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, class int, n string")
    got = ngram_join.jaccard_components(df.repartition(5), block_rows=block_rows).collect()
    assert len(got) == len(rows)
    sets = brute_sets(rows)
    union = Union({k for k, _ in rows if k is not None})
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= 80 * len(s | sets[j]) and None not in (rows[i][0], rows[j][0]):
                union.join(rows[i][0], rows[j][0])
    want = Counter((k, len(s), None if k is None else union.find(k)) for (k, _), s in zip(rows, sets, strict=True))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_small_buckets_are_done_with_before_the_trees(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for i in range(40):  # two unrelated texts share a passage; four sizes
        passage = made_up_text(rng, 30)
        rows += [(10 * i + j, made_up_text(rng, 60 + 10 * (i % 4)) + " " + passage) for j in range(2)]
    written = {}

    def keep(df, name, write=ngram_join.materialize):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(ngram_join, "materialize", keep)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert written["open-buckets"].count() == 0


@pytest.mark.parametrize("batch_rows", [2, 3, 7, 10_000])
def test_buckets_of_any_batches(spark, batch_rows):
    rng = random.Random(13)
    entries = []
    for shingle in range(60):
        for c in rng.sample(range(100), rng.choice((1, 2, 3, 4, 5, 6, 30))):
            n = 20 + c % 7
            entries += [(shingle, c, n << ngram_join.PLACE_BITS | rng.randrange(5))] * rng.choice((1, 1, 2))
    of = {}
    for shingle, c, place in entries:
        of.setdefault(shingle, {})[c] = place
    entries = [(shingle, c, of[shingle][c]) for shingle, c, _ in entries]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        df = spark.createDataFrame(entries, "shingle long, class long, place long")
        got = [tuple(r) for r in ngram_join._buckets(df, 80).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = {(a, b) for s, a, b in got if s is None}

    def may(p, q):
        (n, i), (m, j) = (divmod(x, 1 << ngram_join.PLACE_BITS) for x in (p, q))
        return 180 * min(n - i, m - j) >= 80 * (n + m)

    allowed, wanted = set(), set()
    for classes in of.values():
        found = {(a, b) for a in classes for b in classes if a < b and may(classes[a], classes[b])}
        allowed |= found
        if len(classes) <= ngram_join.SMALL:
            wanted |= found
    assert wanted <= pairs <= allowed
    large = [(s, c, p) for s, classes in of.items() if len(classes) > ngram_join.SMALL for c, p in classes.items()]
    assert sorted(x for x in got if x[0] is not None) == sorted(large)


def test_jaccard_of_no_rows(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in ngram_join.jaccard_components(one).collect()] == [(1, 0, 1)]


def test_tree_gives_exactly_the_pairs_within_the_bound():
    rng = np.random.default_rng(2)
    point = rng.poisson(3, (200, ngram_join.DIMENSIONS))
    point[100:] = point[:100] + (rng.random((100, ngram_join.DIMENSIONS)) < 0.2)
    n = point.sum(axis=1)
    rows = np.arange(200)

    def want(left, right):
        minima = np.minimum(point[left][:, None], point[right][None]).sum(axis=2)
        a, b = np.nonzero(ngram_join.bound_passes(minima, n[left][:, None], n[right][None], 80))
        return {(min(left[i], right[j]), max(left[i], right[j])) for i, j in zip(a, b, strict=True) if left[i] != right[j]}

    for left, right in ((rows, rows), (rows[:90], rows[90:])):
        pairs = [(min(a, b), max(a, b)) for i, j in ngram_join.tree_pairs(n, point, left, rows if right is rows else right, 80) for a, b in zip(i, j, strict=True)]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == want(left, right)


# -- 3 mixing ---------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while True:
        left = total - sum(most * sizes[s] for s in order if s not in open_)
        share = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / share if s in open_ else most * sizes[s] for s in order}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        open_ -= above


@pytest.mark.parametrize("bucket_rows", [8192, 7])
def test_mixing(spark, bucket_rows):
    rng = random.Random(7)
    rows = [(i, made_up_text(rng, rng.randrange(1, 40)), "hot" if i % 3 else f"s{i % 4}") for i in range(300)]
    rows += [(900, "few words", "a-tiny"), (901, None, "hot"), (902, "", "empty"), (903, "x y z", None), (None, "a b", "hot")]
    rows += [(904, "  lead and\n trail ", "s1"), (905, "b " * 2000, "s2"), rows[0]]
    df = spark.createDataFrame([(*r, 5, "q") for r in rows], "doc_id long, text string, source string, size int, taken string")
    got = mixing.mix(df, bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5001 for s in sizes)
    again = mixing.mix(df.repartition(3), bucket_rows=bucket_rows).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixed_corpus(spark):
    rng = random.Random(8)
    rows = [(i, f"  {made_up_text(rng, rng.randrange(1, 30))} ", f"s{i % 5}", 9) for i in range(100)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, n_chars long, taken string")
    mixed = mixing.mix(df)
    want = {r.doc_id: (r.size, r.taken) for r in mixed.collect()}
    got = defaultdict(list)
    taken = mixing.take(df, mixed)
    assert taken.columns == df.columns
    texts = {r[0]: r[1] for r in rows}
    for r in taken.collect():
        n = len(WORD.findall(r.text))
        whole = r.text == texts[r.doc_id]
        assert r.taken == "clash" and texts[r.doc_id].startswith(r.text) and r.n_chars == (9 if whole else len(r.text))
        got[r.doc_id].append(n)
    assert {k: sum(v) for k, v in got.items()} == {k: t for k, (_, t) in want.items() if t}
    none = spark.createDataFrame([], df.schema)
    assert mixing.take(none, mixing.mix(none)).count() == 0


def test_mixed_corpus_of_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(18)
    rows = [(None if i % 2 else i // 8, made_up_text(rng, rng.randrange(1, 30)), f"s{i % 3}") for i in range(120)]
    rows += [rows[0], rows[1], rows[1], (None, "a b c", "s0"), (None, "a b c", "s1"), (7, None, "s2"), (None, "", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key string").select("*", F.col("row_key").alias("source"))
    mixed = mixing.mix(df)
    want, got, whole = defaultdict(int), defaultdict(int), Counter((k, t) for k, t, _ in rows)
    for r in mixed.collect():
        want[r.source] += r.taken
    taken = mixing.take(df, mixed).collect()
    for r in taken:
        got[r.source] += len(WORD.findall(r.text))
    assert got == want
    times = Counter((r.doc_id, r.text) for r in taken)
    assert all(n <= 3 * whole[k] for k, n in times.items() if k in whole)


def test_mixing_with_map_columns_and_many_rows_without_an_id(spark):
    rng = random.Random(28)
    kinds = [None, {}, {"a": 1}, {"a": None}, {"b": 2, "a": 1}]
    rows = [(None, made_up_text(rng, 6), "hot", kinds[i % 5], [kinds[i % 4]]) for i in range(200)]
    rows += [(i, made_up_text(rng, 4), "s1", kinds[i % 5], None) for i in range(20)] + [(None, "same text", "hot", {"a": i}, []) for i in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>, deep array<map<string,int>>")
    mixed = mixing.mix(df, bucket_rows=20)
    got = mixed.collect()
    assert len(got) == len(rows) and len({r.row_key for r in got}) == len(rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 0.5001 for s, t in target.items())
    corpus = mixing.take(df, mixed).collect()
    words = Counter()
    for r in corpus:
        words[r.source] += len(WORD.findall(r.text))
    assert words == taken and all(r.extra is None or set(r.extra) <= {"a", "b"} for r in corpus)
    assert {r.extra is None for r in corpus} == {True, False}


# -- 4 licenses --------------------------------------------------------------------


def brute_licenses(text, templates, containment=0.8):
    """Places of a template, by trying them all."""
    marks = "\"'`*_#()[]{}<>.,;:!?-/|"

    def shingles(t):
        w = [x.strip(marks) for x in re.split(r"[\x20\x09-\x0D]+", (t or "").lower())]
        w = [x for x in w if x]
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    s, found = shingles(text), set()
    for name, template in templates:
        t = shingles(template)
        if t:
            for begin in range(1 - len(t), len(s)):
                span = set(s[max(0, begin - 8) : begin + len(t) + 8])
                if len(set(t) & span) / len(set(t)) >= containment:
                    found.add(name)
    return found


def test_license_scan(spark):
    rng = random.Random(4)
    texts = dict(licenses.TEMPLATES)
    rows = [(i, made_up_text(rng, 60)) for i in range(30)]
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        rows.append((100 + i, f"{made_up_text(rng, 40)}\n{text}\n{made_up_text(rng, 40)}"))
        rows.append((200 + i, f"# {text.upper().replace(' ', '  ')}"))
        w = text.split()
        if len(w) > 40:  # one word in fifty changed: most shingles stay
            w[20] = "altered"
            rows.append((300 + i, f"{made_up_text(rng, 100)} {' '.join(w)} {made_up_text(rng, 5)}"))
            rows.append((400 + i, " ".join(w[:12])))
    rows += [(500, None), (501, ""), (502, "mit"), (None, texts["mit"]), (503, f"{texts['mit']} {made_up_text(rng, 50)} {texts['mit']}")]
    rows += [(504, made_up_text(rng, 5000) + " " + texts["gpl-3.0"]), (200, "nothing here at all of it")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, license int, at string")
    got = licenses.scan(df).collect()
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.license)
    want = defaultdict(set)
    for k, t in rows:
        want[k] |= brute_licenses(t, licenses.TEMPLATES)
    assert by_id == {k: v for k, v in want.items() if v}
    assert len([r for r in got if r.doc_id == 503 and r.license == "mit"]) == 2
    [one] = [r for r in got if r.doc_id == 100 and r.license == "cc-by-nc-4.0"]
    assert (one.start, one.end, one.containment) == (40, 45, 1.0)
    assert licenses.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("between", [0, 3, 12])
def test_license_copies_that_follow_each_other(spark, between):
    rng = random.Random(14)
    name, text = next(t for t in licenses.TEMPLATES if t[0] == "mit-permission")
    lead, gap, n = made_up_text(rng, 11), made_up_text(rng, between), len(text.split())
    df = spark.createDataFrame([(1, f"{lead} {text} {gap} {text} {gap} {text}")], "doc_id long, text string")
    got = sorted((r.start, r.end, r.containment) for r in licenses.scan(df).collect() if r.license == name)
    assert got == [(11 + i * (n + between), 11 + i * (n + between) + n, 1.0) for i in range(3)]


# -- 5 urls --------------------------------------------------------------------------


def brute_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path, host = re.match(r"[^?#]*", rest[len(host) :])[0], host.translate(LOWER)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("rows_per_range", [200_000, 10])
def test_url_rules(spark, rows_per_range):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
    rules += [("example.com", "/en/deep/", "block"), ("hot.org", "/", "block"), ("ot.org", "/", "allow"), ("a.b.net", "", "block")]
    hosts = ["com", "example.com", "EXAMPLE.com", "www.example.com", "x.www.example.com", "example-a.com", "ample.com", "net"]
    hosts += ["a.net", "a.b.net", "c.a.b.net", "hot.org", "shot.org", "localhost", "a..com", ".com", "exa\x01mple.com", "user:pw@h.net:80"]
    paths = ["", "/", "/en/", "/en", "/en/deep/x?y=/es/", "/es/#f", "?q=1", "#top", "/EN/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://c.com/en/"]
    urls += ["http://hot.org/same"] * 60
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, urls[0], "h", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    known = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    got = url_rules.judge(df, known, rows_per_range=rows_per_range).collect()
    want = Counter((k, *brute_verdict(u, rules)) for k, u, *_ in rows)
    assert Counter(tuple(r) for r in got) == want
    assert url_rules.judge(df.limit(0), known).count() == 0
    assert {r.verdict for r in url_rules.judge(df, known.limit(0)).collect()} == {"allow"}


# -- 6 packing -------------------------------------------------------------------------


def test_encoder_agrees_with_the_tokenizer():
    from tokenizers import Tokenizer
    import pyarrow as pa

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    rng = random.Random(6)
    signs = [" ", "  ", "\n", "\n\n", "\t", "a", "word", "Ä", "é", "1", "22", ".", ",", "...", "'s", "'", "<|endoftext|>", "\u00a0", "\u3000", "😀", "\u200b", "́", "\x1c", "\u0085", "ﬁ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), most_kept=2000)
    for at in range(0, len(texts), 300):
        ids, cut = encoder.encode(pa.array([*texts[at : at + 300], None]))
        want = plain.encode_batch(texts[at : at + 300], add_special_tokens=False)
        for i, w in enumerate(want):
            assert ids[cut[i] : cut[i + 1]].tolist() == w.ids, texts[at + i]
        assert cut[-1] == cut[-2]


def test_encoder_finds_added_tokens_as_an_untouched_tokenizer_does():
    from tokenizers import Tokenizer
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(16)
    end = "<|endoftext|>"
    signs = [" ", "  ", "\n", "\n\n", "\t", "a", "word", "é", "1", ".", "'s", "<", "|>", "<|", "endoftext", "\u3000", "😀", end, end]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    texts += [f"a {end} b", end, end * 3, f"{end} ", f" {end}\n\n{end}x", "<|endof", "text|>", "a<|endoftext|", ">b"]
    encoder = packing.Encoder(path, most_kept=500, added_tokens=True)
    for at in range(0, len(texts), 300):
        ids, cut = encoder.encode(pa.array([*texts[at : at + 300], None]))
        want = plain.encode_batch(texts[at : at + 300], add_special_tokens=False)
        for i, w in enumerate(want):
            assert ids[cut[i] : cut[i + 1]].tolist() == w.ids, texts[at + i]
        assert cut[-1] == cut[-2]
    ids, _ = packing.encoder_of(path).encode(pa.array([f"a {end} b"]))
    assert ids.tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_each_piece_once_without_overlap(seed):
    rng = random.Random(seed)
    capacity = 256
    histogram = Counter(rng.choice((rng.randrange(1, 257), rng.randrange(1, 20), 256, 90)) for _ in range(3000))
    runs = packing.plan(histogram, capacity, units=32)
    placed, used = Counter(), defaultdict(list)
    for r in runs:
        placed[r.length] += r.count
        for s in range(r.sequence, r.sequence + r.count):
            used[s].append((r.offset, r.length))
    assert placed == histogram
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    best_fit = packing.Bins(capacity)
    for n in sorted(histogram, reverse=True):
        best_fit.best_fit(n, histogram[n])
    assert sorted(used) == list(range(len(used))) and len(used) <= 1.01 * best_fit.next + 2
    assert packing.plan({}, capacity) == []


def test_nonnegative_least_squares():
    rng = np.random.default_rng(3)
    a, x = rng.random((30, 12)), np.maximum(rng.standard_normal(12), 0)
    assert np.allclose(packing.nonnegative_least_squares(a, a @ x), x, atol=1e-6)


def test_packing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(9)
    rows = [(i, made_up_text(rng, rng.choice((1, 5, 20, 30, 60, 200)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "x " * 4000), (503, "x"), (503, "x"), (None, "no id")]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, piece int, part int")
    got = packing.piece_table(packing.pack(df.repartition(4), path, capacity=128)).collect()
    plain = Tokenizer.from_file(path)
    want = Counter()
    for k, t in rows:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) - (-(-len(ids) // 128) - 1) * 128
        start = 0
        for piece, end in enumerate(range(first, len(ids) + 1, 128)):
            want[(k, piece, start, end - start, crc32(ids[start:end].tobytes()))] += 1
            start = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 128
    assert len(at) <= 1.05 * sum(r.length for r in got) / 128 + 2
    assert packing.piece_table(packing.pack(df.limit(0), path)).count() == 0


# -- 7 top-k -----------------------------------------------------------------------------


@pytest.mark.parametrize("blocks", [(32_768, 4_096), (40, 3)])
def test_top_inner_products(spark, blocks):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(6).round(1).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[10][1]) for i in range(20)] + [(50, [0.0] * 6)] + [(2000, None), (2050, [math.nan] * 6)]
    rows += [(2100, [None] + [1.0] * 5), (2150, [1.0, 2.0]), (2151, [3.0, -2.0]), (None, [1.0] * 6), (2200, []), (2250, [1e9] * 6)]
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<double>, id int, block int")
    got = topk.top_inner_products(df, "vec_id % 50 = 0", 5, rows_per_block=blocks[0], queries_per_block=blocks[1]).collect()
    good = [(k, [math.floor(256 * x) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for q, x in good:
        if q % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(x, y, strict=True)), k) for k, y in good if k != q and len(x) == len(y)))[:5]
            want.update((q, i + 1, k, -s) for i, (s, k) in enumerate(scores))
    # Two rows with id 50 are two queries of one id: their answers are ranked together.
    got = Counter(tuple(r) for r in got if r.query_id != 50)
    assert got == Counter({k: n for k, n in want.items() if k[0] != 50})
    assert topk.top_inner_products(df.limit(0), "vec_id % 50 = 0").count() == 0


def test_threshold_search_stops_early():
    rng = np.random.default_rng(0)
    x = rng.integers(-5, 6, (5000, 3)).astype(float)
    x[7] = [100, 100, 100]
    x[9] = [90, 99, 98]
    lists = topk.Lists(np.arange(5000), x)
    rows, score = lists.search(-1, np.array([1.0, 2.0, 1.0]), 2)
    assert rows.tolist() == [7, 9] and score.tolist() == [400, 386]


# -- 8 quality ---------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    odd = docs.withColumn("c0", F.lit(1)).withColumn("score", F.lit("old"))
    scored = quality.score(odd, model).select("doc_id", "score", quality.is_held_out("doc_id").alias("held"), quality.predict().alias("p"))
    rows = scored.join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held]
    assert sum(r.p == r.quality for r in held) / len(held) > 0.95
    again = quality.train(docs.repartition(3), labels.repartition(2))
    assert np.allclose(model.weight, again.weight) and model[2:] == pytest.approx(again[2:])


def test_quality_of_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a b " * 9000), (3, "twice")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(3, 1), (3, None), (None, 0), (77, 0)], "doc_id long, quality int")):
        got = quality.score(docs, quality.train(docs, labels)).collect()
        assert len(got) == 5 and all(0 < r.score < 1 for r in got)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), none)).count() == 0


def test_dual_coordinate_descent_parts_what_can_be_parted():
    rows = [(np.array([i % 2, 2 + i % 5]), np.ones(2)) for i in range(40)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(40)])
    w, bias = quality.dual_coordinate_descent(rows, y)
    assert all(y[i] * (w[at] @ x + bias) > 0 for i, (at, x) in enumerate(rows))


# -- 9 html ------------------------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home, now.</a></li></ul></nav><div class="cookie-notice">We use cookies, yes.</div>
{open}<h2>A &amp; B</h2><p>First   line,
with <b>bold</b> text. It is long enough to count.<p>Second&nbsp;one &lt;here&gt;, also of some length; indeed.<ul><li>Point one.<li>Point two</ul><p>Short.</p>{close}
<aside><p>Side text, with marks. And more of it, to be long.</p></aside><section id="comments"><p>A comment, by a reader. It is long too.</p></section>
<form><label>Mail</label><input value="x"><p>Sign up, now.</p></form><!-- <p>hidden</p> --><footer>&copy; all, of it.</footer></body></html>"""
ARTICLE = "A & B\n\nFirst line, with bold text. It is long enough to count.\n\nSecond one <here>, also of some length; indeed.\n\nPoint one.\n\nPoint two\n\nShort."


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content with-sidebar">', "</div>"), ("", "")])
def test_main_text(tags):
    assert html.main_text(PAGE.format(open=tags[0], close=tags[1])) == ARTICLE


def test_main_text_of_odd_pages(spark):
    pages = [None, "", "plain text only", "<p>one<p>two", "<nav>menu</nav>", "<script>x", "<!-- open", "<p>a < b & c &#233;", "<b", "</p></div>x"]
    want = ["", "", "plain text only", "one\n\ntwo", "", "", "", "a < b & c é", "", "x"]
    assert [html.main_text(p) for p in pages] == want
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article>"
    rows = [(i, None, p, "clash") for i, p in enumerate([*pages, long])] + [(None, "u", "<p>x", "clash")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(df).collect()
    assert [r.text for r in got[: len(pages)]] == want and got[len(pages)].text.count("\n\n") == 19_999
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)
    assert html.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("sentences", [3, 30, 300])
@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"'])
def test_main_text_keeps_what_stands_around_a_long_body(tag, sentences):
    lead, body, end = "A lead, of some length; it says what follows.", "Long text, with marks. " * sentences, "The end, at last. It sums up."
    page = f"<body><nav><a href=/>Home</a></nav><{tag}><h1>Title</h1><p class=lead>{lead}</p><div class=body>{body}</div><div class=conclusion>{end}</div></{tag.split()[0]}></body>"
    assert html.main_text(page) == "\n\n".join(["Title", lead, body.strip(), end])


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'aria-hidden="false"', 'title="hidden costs"', 'data-id="footer"', "data-role=navigation", "title='a class=ad'"])
def test_values_and_other_attributes_mark_nothing(attrs):
    text = "Some text, of a length. And more of it."
    assert html.main_text(f"<body><div {attrs}><p>{text}</p></div></body>") == text


@pytest.mark.parametrize("attrs", ["hidden", 'hidden=""', "class='x' HIDDEN", "role=navigation", 'id="sidebar"', "class=ad"])
def test_marked_elements_are_no_article(attrs):
    text = "Some text, of a length. And more of it."
    assert html.main_text(f"<body><article><p>{text}</p><div {attrs}>No text, of a length. And more of it.</div></article></body>") == text


def test_sections_of_an_article_may_be_named_as_furniture_is():
    text = "Some text, of a length. And more of it."
    page = f"""<body><article><p>{text}<h2 id="related-work">Related</h2><p id="form">{text}</p>
<section id="discussion"><h2 id="search">Search</h2><p>{text}</p></section><div class="social-share">Share, now.</div></article>
<div id="search">Search here.</div></body>"""
    assert html.main_text(page) == "\n\n".join([text, "Related", text, "Search", text])


LONG = "Some text, of a length; it goes on. And more of it, to be long enough."


@pytest.mark.parametrize(
    "page",
    [
        f"<div><a>Home</a></div><div><a>About</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><span>Copyright line 2024</span></div>",
        f"<table><tr><td>Home News</td></tr><tr><td><p>{LONG}</p><p>{LONG}</p></td></tr><tr><td>All rights kept</td></tr></table>",
    ],
)
def test_ratios_decide_where_no_name_helps(page, monkeypatch):
    assert html.main_text(page) == f"{LONG}\n\n{LONG}"
    monkeypatch.setattr(html, "path_scores", lambda found: {b.path: 1.0 for b in found})
    assert html.main_text(page) != f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize(
    "attrs",
    ['class="share"', 'class="cookie"', 'class="comment"', 'id="respond"', 'class="advertisement"', 'class="sponsor"', 'class="related-posts"'],
)
def test_containers_inside_an_article_that_are_none_of_it(attrs):
    page = f"<body><article><p>{LONG}</p><div {attrs}><p>Other text, of a length. And more.</p></div><p>{LONG}</p></article></body>"
    assert html.main_text(page) == f"{LONG}\n\n{LONG}"


def test_a_discussion_beside_the_article_is_none_of_it():
    page = f'<main><article><h1>Title</h1><p>{LONG}</p></article><section id="discussion"><p>I think so, too.</p></section></main>'
    assert html.main_text(page) == f"Title\n\n{LONG}"


# -- 10 lines ----------------------------------------------------------------------------


def test_line_dedup(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        lines = [made_up_text(rng, 5) for _ in range(3)]
        if i % 4 == 0:
            lines.insert(1, "  Common footer \t")
        if i % 50 == 0:
            lines += ["rare line", "rare line", ""]
        rows.append((i, "hot" if i % 3 else f"h{i % 5}", "\n".join(lines)))
    rows += [(900, None, "Common footer\nx"), (901, "hot", None), (902, "hot", ""), (903, "hot", "Common footer"), rows[0]]
    rows += [(904, "hot", "Common footer\r\n\n" + "y\n" * 3000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, _lines int, n_dropped int")
    got = line_dedup.drop_boilerplate(df).collect()
    pages, with_line = Counter(), Counter()
    for _, host, text in rows:
        pages[host] += 1
        with_line.update({(host, x.strip(" \t\r\f\v")) for x in (text or "").split("\n")})
    want = Counter()
    for key, host, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = []
        for x in lines:
            k = x.strip(" \t\r\f\v")
            n = with_line[(host, k)]
            if not (host is not None and k and n >= 5 and n > 0.05 * pages[host]):
                kept.append(x)
        want[(key, host, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    assert Counter((r.doc_id, r.source, r.text, r.n_lines, r.n_dropped) for r in got) == want
    assert any(r.n_dropped for r in got)
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


# -- rows that share an id ------------------------------------------------------


def test_license_places_of_rows_that_share_an_id(spark):
    name, text = next(t for t in licenses.TEMPLATES if len(t[1].split()) > 40)
    before = {7: (2, 10, 90), None: (1, 7, 60), 8: (0,)}
    rows = [(k, "word " * n + text, {"a": n}) for k, at in before.items() for n in at] + [(7, "word word " + text, {})]
    df = spark.createDataFrame(rows, "doc_id long, text string, key map<string,int>")
    found = [r for r in licenses.scan(df.select("doc_id", "text"), licenses.TEMPLATES).collect() if r.license == name]
    assert sorted((r.doc_id or -1, r.start) for r in found) == sorted((k or -1, n) for k, at in before.items() for n in at)
    more = [r for r in licenses.scan(df, licenses.TEMPLATES).collect() if r.license == name]
    assert len(more) == len(found)


def test_the_classifier_learns_from_one_document_of_an_id(spark):
    """Thousands of copies of one labelled id neither crowd out the others nor grow what is fitted."""
    rng = random.Random(8)
    rows = [(i, made_up_text(rng, 40, 60) if i % 2 else made_up_text(rng, 40, 60).upper() + " !!!") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    crowd = [(1, "spam " * 30)] * 3_000 + [(1, None)] * 50
    plain = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, sample_rows=100)
    crowded = quality.train(spark.createDataFrame(rows + crowd, "doc_id long, text string"), labels, sample_rows=100)
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    for model in (plain, crowded):
        scored = quality.score(texts, model).collect()
        assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored) >= 180
