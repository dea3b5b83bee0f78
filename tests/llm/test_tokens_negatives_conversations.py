"""Token files, hard negatives and conversation repair against round trips and brute force, with odd rows and columns."""

import hashlib
import itertools
import math
import random
import struct
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from yardstar.llm import conversations as conv
from yardstar.llm import negatives, simple8b, text, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# -- 11 token files -----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_simple8b_round_trip(seed):
    rng = random.Random(seed)
    edges = [0, 1, 2, 3, 7, 14, 15, 127, 255, 1023, 4095, 32766, 32767, 2**20 - 1, 2**30 - 1, 2**60 - 1, 2**60, 2**64 - 1]
    for _ in range(60):
        n = rng.choice([0, 1, 2, 59, 60, 61, 240, 241, rng.randrange(500)])
        values = np.array([rng.choice(edges) if rng.random() < 0.5 else 0 for _ in range(n)], np.uint64)
        coded, escapes = simple8b.encode(values)
        assert (simple8b.decode(coded, escapes, n) == values).all()


def test_simple8b_packs_small_numbers_and_lets_a_large_one_escape():
    assert len(simple8b.encode(np.zeros(2400, np.uint64))[0]) == 10
    assert len(simple8b.encode(np.ones(600, np.uint64))[0]) == 10
    mixed = np.full(80, 100, np.uint64)
    mixed[40] = 2**40
    coded, escapes = simple8b.encode(mixed)
    assert len(coded) == 10 and escapes.tolist() == [2**40]


def test_simple8b_of_words_full_of_escapes_and_short_ends():
    rng = np.random.default_rng(8)
    for n in (1, 239, 240, 241, 500):
        for share in (0, 0.02, 0.5, 1):
            values = np.where(rng.random(n) < share, 2**40, rng.integers(0, 2, n)).astype(np.uint64)
            coded, escapes = simple8b.encode(values)
            assert (simple8b.decode(coded, escapes, n) == values).all()
            assert len(coded) + len(escapes) <= n


def test_powers_are_made_once():
    assert np.shares_memory(text.powers(10, text.BASE), text.powers(20, text.BASE))
    for n in (0, 1, 1000):
        assert text.powers(n, text.BASE).tolist() == [pow(int(text.BASE), i, 1 << 64) for i in range(n)]
    assert len(text.powers(text.KEPT_POWERS + 1, text.BASE)) == text.KEPT_POWERS + 1


ALPHABET = ["a", "B", "é", "é", "'", "s", "'LL", " ", "\n", " ", "　", "-", "<|", "|>", "<|endoftext|>"]
ALPHABET += ["<|STARTOFTEXT|>", "<|startoftext|>", "İ", "Σ", "ß", "1", "23", "٣", "≠", "!", ".", "\x1c", "中", "😀", "\x00"]


def test_word_encoder_gives_what_the_tokenizer_gives():
    rng = random.Random(2)
    encoder, plain = token_files.WordEncoder(WORD_BPE, most_kept=300), Tokenizer.from_file(WORD_BPE)
    assert encoder.by_word
    for _ in range(60):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(20)] + [None]
        ids, at = encoder.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_an_encoder_of_another_tokenizer_takes_texts_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = token_files.WordEncoder(path), Tokenizer.from_file(path)
    ids, at = encoder.encode(pa.array(["Two words.", None, " x"]))
    assert not encoder.by_word and at.tolist()[1] == at.tolist()[2]
    assert ids.tolist() == [i for t in ("Two words.", " x") for i in plain.encode(t, add_special_tokens=False).ids]


def test_token_files_round_trip(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"word{rng.randrange(900)}" for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += [None, "", " \n", "Same text", "Same text", "x " * 90_000, "A <|endoftext|> b"]
    ids = [*range(-3, len(texts) - 7), 5, 5, None, None, 2**63 - 1, -(2**63)][: len(texts)]
    rows = list(zip(ids, texts, strict=True))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, {"k": 1}, "c") for i, t in rows], "doc_id long, text string, ids map<string,int>, start string")
    path = str(tmp_path / "set")
    token_files.write(df.repartition(5), path, WORD_BPE, end_id=2)
    got = token_files.read(spark, path).withColumn("sum", F.crc32("ids")).orderBy("start", "n_tokens").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    plain = Tokenizer.from_file(WORD_BPE)
    want, start, stream = defaultdict(list), 0, []
    for i, t in rows:
        want[i].append(tuple([*plain.encode(t or "", add_special_tokens=False).ids, 2]))
    found = defaultdict(list)
    for r in got:
        its = struct.unpack(f"<{r.n_tokens}I", r.ids)
        assert r.start == start and r.sum == crc32(r.ids)
        start += r.n_tokens
        stream += its
        found[r.doc_id].append(its)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    for at, n in ((0, 3), (start - 5, 50), (start // 3, 70_000), (start, 4)):
        assert token_files.read_ids(path, at, n).tolist() == stream[at : at + n]
    with pytest.raises(Exception, match="already holds a data set"):
        token_files.write(df, path, WORD_BPE)


def test_token_files_of_an_empty_table_and_small_files(spark, tmp_path, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write(empty, str(tmp_path / "none"), WORD_BPE)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0
    assert token_files.read_index(str(tmp_path / "none"))["ids"] == 0


def test_a_file_of_a_lost_attempt_is_never_read(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    path = str(tmp_path / "set")
    token_files.write(df, path, WORD_BPE)
    (tmp_path / "set" / "part-000000-0000-lost.s8b").write_bytes(b"cut short")
    assert token_files.read(spark, path).count() == 20


def test_a_writer_cuts_files_and_readers_cross_blocks(tmp_path):
    ids = np.arange(200_000, dtype=np.uint64) % 49_000
    with open(tmp_path / "one.s8b", "wb") as stream:
        out = token_files.FileWriter(stream)
        out.append(np.array([1, 2]), 1, np.array([70_000, 70_000, 60_000]), ids)
        out.close()
    with pa.OSFile(str(tmp_path / "one.s8b")) as stream:
        file = token_files.FileReader(stream)
        assert (file.n_null, file.doc_ids.tolist(), file.lengths.tolist()) == (1, [1, 2], [70_000, 70_000, 60_000])
        assert len(file.blocks) == 4 and (file.ids(65_000, 140_001) == ids[65_000:140_001]).all()


# -- 12 hard negatives -----------------------------------------------------------------


def brute_negatives(rows, is_anchor, n_positives=5, n_negatives=3):
    """The same from all pairs; equal rows are candidates of their own, ids of several rows are one anchor."""
    good = []
    for key, label, v in rows:
        if key is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.append((key, label, [math.floor(256 * x) for x in v], v))
    anchors = {}
    for key, label, x, v in good:
        if is_anchor(key) and (key not in anchors or (label, v) < (anchors[key][0], anchors[key][2])):
            anchors[key] = (label, x, v)
    out = []
    for a, (label, x, _) in anchors.items():
        scored = [
            (-sum(p * q for p, q in zip(x, y, strict=True)), key, its)
            for key, its, y, _ in good
            if key != a and len(x) == len(y)
        ]
        positives = sorted(s for s in scored if s[2] == label)[:n_positives]
        for at, (p, positive, _) in enumerate(positives, 1):
            fits = sorted(s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)[:n_negatives]
            out += [(a, positive, rank, n, -p, -s, at) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def check_negatives(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, cluster string")
    got = negatives.mine(df, "vec_id % 10 = 0", **more).collect()
    want = brute_negatives(rows, lambda key: key % 10 == 0)
    assert sorted(tuple(r) for r in got) == want
    return len(want)


def test_hard_negatives(spark):
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((6, 12))
    rows = [(i, int(rng.integers(4)), (middles[i % 6] + 0.4 * rng.standard_normal(12)).tolist()) for i in range(400)]
    rows += [(i, 1, rows[7][2]) for i in range(500, 530)] + [rows[11]] * 9 + [(40, 3, rows[12][2]), (40, 0, rows[13][2])]
    rows += [(600, 2, [0.0] * 12), (601, 2, [1.0, 2.0]), (610, 1, [1.0, 2.0]), (611, 1, [1.5, 1.0]), (612, 3, [0.5, 1.5])]
    rows += [(620, 2, [1e6] * 12), (621, 2, [1.5e6] * 12), (622, 1, [1.2e6 - i for i in range(12)])]
    rows += [(None, 1, rows[0][2]), (630, None, rows[0][2]), (640, 1, None), (650, 1, []), (660, 1, [math.nan] * 12)]
    rows += [(670, 1, [None] * 12), (680, 1, [math.inf] * 12)]
    assert check_negatives(spark, rows) > 200
    assert check_negatives(spark, rows, rows_per_block=64, anchors_per_cluster=3) > 200


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<double>")
    assert negatives.mine(df, "vec_id % 10 = 0").count() == 0
    df = spark.createDataFrame([(1, 1, [1.0]), (2, 2, [1.0])], "vec_id long, label int, embedding array<double>")
    assert negatives.mine(df, "vec_id % 10 = 0").count() == 0


def test_the_walk_ends_before_the_end_of_its_list():
    rng = np.random.default_rng(3)
    center = np.zeros(16)
    center[0] = 1000.0
    members = np.floor(center + rng.standard_normal((5, 16)))
    near, far = center + 20 * rng.standard_normal((50, 16)), 300 * rng.standard_normal((5_000, 16))
    far[:, 0] = -np.abs(far[:, 0])
    vectors = np.floor(np.concatenate([far, near]))
    shared = negatives.SharedList(np.arange(len(vectors)), vectors, members)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            Counted.read = max(Counted.read, key.stop)
            return np.asarray(self)[key]

    shared.vectors = shared.vectors.view(Counted)
    low, high = np.full((5, 1), -np.inf), np.full((5, 1), np.inf)
    member, _, place, score = negatives.walk(shared, members, np.full(5, -1), low, high, 5, step=64)
    assert Counted.read <= 128
    scores = members @ vectors.T
    for i in range(5):
        best = sorted(zip(-scores[i], range(len(vectors)), strict=True))[:5]
        assert [(-s, shared.ids[p]) for s, p in zip(score[member == i], place[member == i], strict=True)] == best


# -- 13 conversations ------------------------------------------------------------------


SPACE = " \t\n\v\f\r"


def fault_of(text, seen, key):
    inked = text.strip(SPACE)
    if not inked:
        return "blank"
    if key in seen:
        return "duplicate"
    return "" if inked[-1] in ".!?" else "truncated"


def brute_repair(rows):
    """Cheapest and ASCII-least edits of ``(turn, role, text)`` rows, by growing all edits of each state row by row."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda q: (q[0] is not None, q[0] or 0, hashlib.md5(f"{q[1]}:{q[2]}".encode()).hexdigest()),
    )
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append(fault_of(text, seen, (role, text)))
        seen.add((role, text))
    turn = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "a": {"u": "u"}, "u": {"a": "a"}}
    names = {"u": "user", "a": "assistant"}

    def grown(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for made in set(turn[state]) - {"s"}:
                    new = (cost + 2, audit + "I", [*lines, names[made] + ":"])
                    if made not in states or new[:2] < states[made][:2]:
                        states[made] = new
        return states

    states = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, lines) in grown(states).items():
            ways = [(state, cost + 3, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in turn[state]:
                    ways.append((role[:1], cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
                for made in set(turn[state]) - {"s"}:
                    ways.append((made, cost + 2 + extra, audit + "R", [*lines, f"{names[made]}:{text}"]))
            for to, *way in ways:
                if to not in after or tuple(way[:2]) < after[to][:2]:
                    after[to] = tuple(way)
        states = after
    cost, audit, lines = min(v for k, v in grown(states).items() if k in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def made_up_conversations(rng, n):
    rows = []
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "assistant2"]
    texts = ["Yes.", "No!", "Why?", "cut", "a longer one that is cut, ", "Done. \n", "", " \t", None, ".", "é…", "Line.\nno"]
    for c in range(n):
        at = 0
        for _ in range(rng.choice([1, 2, 5, 12, 30])):
            at += rng.choice([0, 1, 1, 1, 3])
            row = (c, None if rng.random() < 0.05 else at, rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 1, 4])
    return rows


@pytest.mark.parametrize("piece_rows", [2, 4096])
def test_conversation_repair(spark, piece_rows):
    rng = random.Random(piece_rows)
    rows = made_up_conversations(rng, 40) + [(None, 1, "user", "Who?"), (None, None, "assistant", "me")]
    rows += [(50, i, "user", f"{i}.") for i in range(70)] + [(51, 1, "user", "cut")] * 500
    schema = "conv_id long, turn long, role string, text string, audit string, c int, piece map<string,int>"
    df = spark.createDataFrame([(*r, "x", 1, {}) for r in rows], schema)
    got = conv.summary(df, conv.repair(df, piece_rows=piece_rows)).collect()
    by_conv = defaultdict(list)
    for c, *row in rows:
        by_conv[c].append(row)
    assert len(got) == len(by_conv)
    for r in got:
        assert {k: v for k, v in r.asDict().items() if k != "conv_id"} == brute_repair(by_conv[r.conv_id]), r.conv_id


def test_damage_and_conversations_without_a_row_left(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"Text {t}. ok?") for c in range(120) for t in range(1 + c % 2)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged = conv.damage(df)
    got = {r.conv_id: r for r in conv.summary(df, conv.repair(damaged, copies=F.col("copies"))).collect()}
    assert set(got) == {c for c, *_ in rows}
    by_conv = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        d = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = " " if text is None else text
        text = "" if d == 1 else "".join(x for x in text if d != 2 or x not in ".!?")
        by_conv[c] += [(t, "user" if d == 4 else role, text)] * {0: 0, 3: 2}.get(d, 1)
    gone = [c for c, its in by_conv.items() if not its]
    assert gone
    for c, its in by_conv.items():
        want = brute_repair(its)
        assert {k: v for k, v in got[c].asDict().items() if k != "conv_id"} == want
    assert got[gone[0]].repaired_sha256 == hashlib.sha256(b"").hexdigest() and got[gone[0]].cost == 0


def test_edits_are_a_table_of_what_was_done(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "more"), (1, 4, "system", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = conv.edits(conv.repair(df)).orderBy("part", "piece", "seq").collect()
    assert "".join(r.edit * r.times for r in done) == "KDRD" or sum(r.cost for r in done) == brute_repair([r[1:] for r in rows])["cost"]
    kept = [f"{r.role}:{r.text}" for r in done if r.edit != "D"]
    assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == brute_repair([r[1:] for r in rows])["repaired_sha256"]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conv.summary(df, conv.repair(df)).count() == 0


def test_powers_of_a_run_are_its_rows_one_by_one():
    for symbol in range(16):
        if symbol % 4 == 3:
            continue
        m = conv.matrix_of([(symbol, 1)])
        slow = m
        for n in range(2, 40):
            slow = conv.product(slow, m)
            assert (conv.matrix_of([(symbol, n)]) == slow).all()
