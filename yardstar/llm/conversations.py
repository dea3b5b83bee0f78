"""Conversation structure repair: a run-length DP over role and fault symbols with min-plus transitions.

The structure wanted is ``(s?(ua)+)?`` over the initials of the roles. A
reader of it has four states; what a row may cost from state to state is a
four by four matrix over (min, +), insertions before the row included. Equal
consecutive symbols are one run, and a run of n rows is the n-th power of its
matrix, put together from binary powers that are kept. Matrices multiply
associatively, so a conversation of any length is cut into pieces: pieces give
their matrix, a pass over matrices gives the cost still to come behind each
piece, and pieces then unroll their choices on their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from yardstar.llm.common import materialize

# States: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: The state that a turn of each initial leads to, from each state it may follow.
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: From each state, the one turn that can be made up there, by inserting it or giving a row that role.
MADE = {state: (role, to) for role in "ua" for state, to in STEP[role].items()}
ROLE = {"u": "user", "a": "assistant"}
INITIALS = "sua"  # any other initial fits nowhere as it is
DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
MUST_GO, CUT_SHORT = 1, 2  # faults of a symbol: blank or duplicate, truncated
LEGAL = {"su", "ua", "au"}
INF = 1 << 60

# -- matrices over (min, +) ----------------------------------------------------


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), INF)


def _insertions() -> np.ndarray:
    """Cheapest way from state to state by insertions alone."""
    m = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(m, 0)
    for state, (_, to) in MADE.items():
        m[state, to] = INSERT_COST
    for _ in range(3):
        m = product(m, m)
    return m


INSERTIONS = _insertions()


def options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of what can be done to a row, the least letter first."""
    initial, fault = divmod(symbol, 4)
    found = [(DELETE, DELETE_COST, state)]
    if fault != MUST_GO:
        extra = TRUNCATED_COST if fault == CUT_SHORT else 0
        to = STEP[INITIALS[initial]].get(state) if initial < len(INITIALS) else None
        if to is not None:
            found.append((KEEP, extra, to))
        if state in MADE:
            found.append((REROLE, REROLE_COST + extra, MADE[state][1]))
    return found


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> np.ndarray:
    """The matrix of ``2 ** exponent`` rows of one symbol, insertions before each of them included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    m = np.full((4, 4), INF, np.int64)
    for state in range(4):
        for _, cost, to in options(symbol, state):
            m[state, to] = min(m[state, to], cost)
    return product(INSERTIONS, m)


def run_powers(symbol: int, n: int) -> list[np.ndarray]:
    """Matrices whose product is that of a run of ``n`` rows."""
    return [power(symbol, e) for e in range(n.bit_length()) if n >> e & 1]


def matrix_of(runs: Iterable[tuple[int, int]]) -> np.ndarray:
    m = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(m, 0)
    for symbol, n in runs:
        for p in run_powers(symbol, n):
            m = product(m, p)
    return m


def cost_to_come(m: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """What is left to pay from each state before rows of matrix ``m``, given that behind them."""
    return np.minimum((m + behind[None, :]).min(axis=1), INF)


#: Behind the last row only insertions can come.
AT_END = np.minimum.reduce([INSERTIONS[:, f] for f in FINAL])

# -- unrolling -------------------------------------------------------------------


def unroll(runs: list[tuple[int, int]], state: int, behind: np.ndarray) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of a piece from ``state`` on, as letters, and the state after them.

    The costs to come are found backwards for whole runs, from binary powers,
    and inside a run for each of its rows; of the edits that pay no more than
    the least, the one with the least letter is taken. From a state a letter
    leads to one state only, so this gives the least string. Rows that must go
    change no state, and no insertion is less than theirs: they go in one step.
    """
    left = [behind]
    for symbol, n in reversed(runs):
        cost = left[-1]
        for p in run_powers(symbol, n):
            cost = cost_to_come(p, cost)
        left.append(cost)
    left.reverse()
    edits: list[str] = []
    for (symbol, n), after in zip(runs, left[1:], strict=True):
        if symbol % 4 == MUST_GO:
            edits.append(DELETE * n)
            continue
        to_come = [after]
        for _ in range(n):
            to_come.append(cost_to_come(power(symbol, 0), to_come[-1]))
        for row in range(n):
            before, behind_row = to_come[n - row], to_come[n - row - 1]
            letter = INSERT
            while letter == INSERT:
                due = before[state]
                choices = [(letter, to) for letter, cost, to in options(symbol, state) if cost + behind_row[to] == due]
                if state in MADE and INSERT_COST + before[MADE[state][1]] == due:
                    choices.append((INSERT, MADE[state][1]))
                letter, state = min(choices)
                edits.append(letter)
    return "".join(edits), state


def closing(state: int) -> str:
    """Insertions behind the last row."""
    edits = ""
    while AT_END[state]:
        edits += INSERT
        state = MADE[state][1]
    return edits


# -- rows and symbols --------------------------------------------------------------

NOT_SPACE = r"[^\x20\x09-\x0D]"


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(NOT_SPACE)


def is_truncated(text: Column) -> Column:
    """The last character that is no white space ends no sentence."""
    return ~F.coalesce(text, F.lit("")).rlike(r"[.!?][\x20\x09-\x0D]*\z")


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows with the faults that ``crc32("conv_id:turn") % 20`` deals out; NULL ids, turns, roles and texts write as a space.

    Of twenty values 0 drops the row, 1 empties its text, 2 takes out ``.!?``,
    3 repeats the row and 4 makes it the user's.
    """

    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col)).cast("binary")) % 20
    text = plain("text")
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(plain("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _faults(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """One row for rows equal in conversation, turn, role and text: ``c, t, r, x, n, m`` and the fault of the first of them.

    Whether role and text were seen in an earlier turn is a comparison with
    the least turn that has them, found by an aggregate.
    """
    same = rows.select(
        F.col(conv).alias("c"),
        F.col(turn).cast("long").alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("r"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("x"),
        copies.alias("n"),
    )
    same = same.groupBy("c", "t", "r", "x").agg(F.sum("n").alias("n")).where("n > 0")
    keyed = materialize(same.withColumn("m", F.md5(F.concat("r", F.lit(":"), "x").cast("binary"))), "turns")
    # Only texts that stand in several turns have an earlier one; NULL comes before all turns.
    turns = keyed.groupBy("c", "m").agg(
        F.count("*").alias("turns"), F.count("t").alias("with_turn"), F.min("t").alias("least")
    )
    turns = turns.where("turns > 1").select(
        F.col("c").alias("c2"), F.col("m").alias("m2"), F.when(F.col("turns") == F.col("with_turn"), F.col("least")).alias("least")
    )
    joined = keyed.join(turns, keyed["c"].eqNullSafe(turns["c2"]) & (keyed["m"] == turns["m2"]), "left")
    repeated = F.col("m2").isNotNull() & ~F.col("t").eqNullSafe(F.col("least"))
    fault = F.when(is_blank(F.col("x")), "blank").when(repeated, "duplicate").when(is_truncated(F.col("x")), "truncated")
    return joined.select("c", "t", "r", "x", "n", "m", fault.alias("fault"))


def _symbol(fault: Column, role: Column) -> Column:
    first = F.substring(role, 1, 1)
    initial = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        initial = F.when(first == letter, i).otherwise(initial)
    kind = F.when(fault.isin("blank", "duplicate"), MUST_GO).when(fault == "truncated", CUT_SHORT).otherwise(0)
    return (initial * 4 + kind).cast("int")


# -- the operator --------------------------------------------------------------------


def _stream(df: DataFrame, schema: T.StructType, rows: Callable[[Iterator[tuple]], Iterator[tuple]], batch: int = 1024) -> DataFrame:
    """``rows`` over the rows of each partition in their order, a batch at a time."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = zip(*given, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for row in rows(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            given.append(row)
            if len(given) == batch:
                yield packed()
                given = []
        if given:
            yield packed()

    return df.mapInArrow(run, schema)


def _schema(conv: T.DataType, fields: str) -> T.StructType:
    return T.StructType([T.StructField("c", conv), *T.StructType.fromDDL(fields)])


class Repair(NamedTuple):
    turns: DataFrame  # c, t, r, x, n, fault, symbol, part, piece, row: rows in order, equal ones as one of n
    pieces: DataFrame  # c, part, piece, first, last, illegal: initials at the ends, illegal neighbours between
    plan: DataFrame  # c, part, piece, state, audit: the state before each piece and its edits


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
    piece_rows: int = 4096,
) -> Repair:
    """The cheapest edits that give every conversation the structure ``(s?(ua)+)?`` of role initials.

    Rows are taken by turn, NULL first, rows of one turn by a hash of role and
    text; a NULL role or text is one space, rows of a NULL conversation are one
    conversation. A row's first fault counts: blank, duplicate (role and text
    stand in an earlier row) or truncated. Keeping a row costs 0, giving it the
    role user or assistant 2, deleting it 3, inserting a turn without text 2;
    blank rows and duplicates must go, each truncated one that stays costs 1.
    Of the cheapest edits those count whose letters come first in ASCII.
    ``copies`` says how often a row stands there (0: not at all). Other columns
    are left out; an empty table gives empty tables.

    Equal rows are counted before any shuffle. Rows are sorted over ranges of
    (conversation, turn), and pieces of ``piece_rows`` rows are the groups, so
    a conversation of any length is spread. Only pieces' matrices and states
    pass through one task a conversation, one after the other.
    """
    order = [F.asc_nulls_first("c"), F.asc_nulls_first("t"), F.asc("m")]
    found = _faults(rows, conv_col, turn_col, role_col, text_col, F.lit(1).cast("long") if copies is None else copies)
    found = found.withColumn("symbol", _symbol(F.col("fault"), F.col("r")))
    found = found.repartitionByRange(*order).sortWithinPartitions(*order).drop("m")
    conv = found.schema["c"].dataType

    def number(given: Iterator[tuple]) -> Iterator[tuple]:
        part, piece, begun, before = TaskContext.get().partitionId(), -1, 0, ()
        for i, row in enumerate(given):
            if (row[0],) != before or i - begun >= piece_rows:
                piece, begun, before = piece + 1, i, (row[0],)
            yield *row, part, piece, i

    numbers = "part int, piece long, row long"
    turns = T.StructType([*found.schema.fields, *T.StructType.fromDDL(numbers)])
    turns = materialize(_stream(found, turns, number, batch=64), "numbered-turns")

    row = F.struct("row", "symbol", "n", F.substring("r", 1, 1).alias("i"))
    grouped = turns.groupBy("part", "piece").agg(F.first("c").alias("c"), F.sort_array(F.collect_list(row)).alias("rows"))

    def described(given: Iterator[tuple]) -> Iterator[tuple]:
        for c, part, piece, its in given:
            runs: list[list[int]] = []
            illegal, before = 0, None
            for r in its:
                # Of equal rows only the first can stay; the others go as what they are, blank or repeated.
                for symbol, n in ((r["symbol"], 1), (r["symbol"] // 4 * 4 + MUST_GO, r["n"] - 1)):
                    if n and runs and runs[-1][0] == symbol:
                        runs[-1][1] += n
                    elif n:
                        runs.append([symbol, n])
                illegal += before is not None and before + r["i"] not in LEGAL
                illegal += (r["n"] - 1) * (2 * r["i"] not in LEGAL)
                before = r["i"]
            yield c, part, piece, its[0]["i"], before, illegal, runs, matrix_of(runs).ravel().tolist()

    fields = "part int, piece long, first string, last string, illegal long, runs array<array<long>>, matrix array<long>"
    pieces = materialize(_stream(grouped.select("c", "part", "piece", "rows"), _schema(conv, fields), described), "pieces")

    def backwards(given: Iterator[tuple]) -> Iterator[tuple]:
        held = None
        for c, part, piece, runs, matrix in given:
            if held is not None:
                yield *held, held[0] != c
            behind = AT_END if held is None or held[0] != c else cost_to_come(np.reshape(m, (4, 4)), np.array(held[4]))
            m = matrix
            held = (c, part, piece, runs, behind.tolist())
        if held is not None:
            yield *held, True

    fields = "part int, piece long, runs array<array<long>>, behind array<long>, begins boolean"
    down = pieces.select("c", "part", "piece", "runs", "matrix").repartition("c")
    down = down.sortWithinPartitions(F.asc("c"), F.desc("part"), F.desc("piece"))
    costs = _stream(down, _schema(conv, fields), backwards)

    def unrolled(given: Iterator[tuple]) -> Iterator[tuple]:
        for c, part, piece, runs, behind, begins in given:
            states = [START] if begins else range(4)
            found = [unroll(runs, s, np.array(behind)) for s in states]
            yield c, part, piece, [audit for audit, _ in found], [to for _, to in found]

    fields = "part int, piece long, audits array<string>, states array<int>"
    ways = _stream(costs.repartition("part", "piece"), _schema(conv, fields), unrolled, batch=64)

    def forwards(given: Iterator[tuple]) -> Iterator[tuple]:
        held = None
        for c, part, piece, audits, states in given:
            state = START
            if held is not None and held[0] == c:
                state = after
                yield held
            elif held is not None:
                yield *held[:4], held[4] + closing(after)
            held = (c, part, piece, state, audits[state])
            after = states[state]
        if held is not None:
            yield *held[:4], held[4] + closing(after)

    up = ways.repartition("c").sortWithinPartitions("c", "part", "piece")
    plan = materialize(_stream(up, _schema(conv, "part int, piece long, state int, audit string"), forwards, batch=64), "edits-of-pieces")
    return Repair(turns, pieces.drop("runs", "matrix"), plan)


def edits(repaired: Repair) -> DataFrame:
    """``(c, part, piece, seq, edit, times, cost, role, text)``: what is done, in order, with role and text of what stays or comes.

    Each piece is a group of its own: its letters and its rows, read side by side.
    """
    plan, turns = repaired.plan, repaired.turns
    conv = plan.schema["c"].dataType
    head = plan.select("c", "part", "piece", F.lit(-1).cast("long").alias("row"), "state", "audit", *_nothing("r string, x string, n long, symbol int"))
    rows = turns.select("c", "part", "piece", "row", *_nothing("state int, audit string"), "r", "x", "n", "symbol")

    def apply(given: Iterator[tuple]) -> Iterator[tuple]:
        def turn(letter: str, times: int, role: str, text: str | None, symbol: int) -> tuple:
            nonlocal seq, state
            cost = {DELETE: DELETE_COST, INSERT: INSERT_COST, KEEP: 0, REROLE: REROLE_COST}[letter] * times
            if letter in (INSERT, REROLE):
                initial, state = MADE[state]
                role = ROLE[initial]
            elif letter == KEEP:
                state = STEP[role[:1]][state]
            if letter in (KEEP, REROLE) and symbol % 4 == CUT_SHORT:
                cost += TRUNCATED_COST
            stays = letter != DELETE
            seq += 1
            return c, part, piece, seq, letter, times, cost, role if stays else None, text if stays else None

        letters, at, seq, state, c, part, piece = "", 0, 0, START, None, 0, 0
        for new in given:
            if new[3] < 0:
                for letter in letters[at:]:  # behind the last row
                    yield turn(letter, 1, "", "", 0)
                c, part, piece, _, state, letters = new[:6]
                at, seq = 0, -1
                continue
            role, text, n, symbol = new[6:]
            while letters[at] == INSERT:
                yield turn(INSERT, 1, "", "", 0)
                at += 1
            yield turn(letters[at], 1, role, text, symbol)
            if n > 1:
                yield turn(DELETE, n - 1, role, text, symbol)
            at += n
        for letter in letters[at:]:
            yield turn(letter, 1, "", "", 0)

    fields = "part int, piece long, seq long, edit string, times long, cost long, role string, text string"
    both = head.unionByName(rows).repartition("part", "piece").sortWithinPartitions("part", "piece", "row")
    return _stream(both, _schema(conv, fields), apply, batch=64)


def _nothing(fields: str) -> list[Column]:
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(fields)]


def digest(done: DataFrame) -> DataFrame:
    """``(c, cost, audit, repaired_sha256)`` of each conversation, from its edits.

    SHA-256 of a text can't be put together from parts, so a conversation's
    edits pass through one task, in order and a batch at a time; nothing but
    the letters of the audit is kept.
    """
    conv = done.schema["c"].dataType

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        before, audit, cost, sha, lines = None, [], 0, None, 0
        for c, edit, times, its_cost, role, text in given:
            if before != (c,):
                if before is not None:
                    yield *before, cost, "".join(audit), sha.hexdigest()
                before, audit, cost, sha, lines = (c,), [], 0, hashlib.sha256(), 0
            audit.append(edit * times)
            cost += its_cost
            if edit != DELETE:
                sha.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
                lines += 1
        if before is not None:
            yield *before, cost, "".join(audit), sha.hexdigest()

    rows = done.repartition("c").sortWithinPartitions("c", "part", "piece", "seq")
    rows = rows.select("c", "edit", "times", "cost", "role", "text")
    return _stream(rows, _schema(conv, "cost long, audit string, repaired_sha256 string"), run, batch=64)


def summary(conversations: DataFrame, repaired: Repair, conv_col: str = "conv_id") -> DataFrame:
    """A row for each conversation: faults, gaps between its turns, illegal neighbours, cost, audit and hash of the repaired text.

    Every conversation of ``conversations`` has one, also without any row left:
    zeros, an empty audit and the hash of the empty text.
    """
    n, fault = F.col("n"), F.col("fault")
    more = F.when(fault == "blank", 0).otherwise(n - 1)
    by_turn = repaired.turns.groupBy("c", "t").agg(
        F.sum(F.when(fault == "blank", n).otherwise(0)).alias("blank"),
        F.sum(F.when(fault == "duplicate", 1).otherwise(0) + more).alias("duplicate"),
        F.sum(F.when(fault == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    counted = by_turn.groupBy("c").agg(
        (F.max("t") - F.min("t") + 1 - F.count("t")).alias("gaps"), *(F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated"))
    )
    before = F.lag("last").over(Window.partitionBy("c").orderBy("part", "piece"))
    beside = F.concat(before, "first")
    pieces = repaired.pieces.withColumn("beside", (beside.isNotNull() & ~beside.isin(*sorted(LEGAL))).cast("long"))
    illegal = pieces.groupBy("c").agg(F.sum(F.col("illegal") + F.col("beside")).alias("illegal"))
    found = digest(edits(repaired)).withColumnRenamed("c", "c0")
    for df, name in ((counted, "c1"), (illegal, "c2")):
        df = df.withColumnRenamed("c", name)
        found = found.join(df, found["c0"].eqNullSafe(df[name]))
    everyone = conversations.select(F.col(conv_col).alias("id")).distinct()
    all_found = everyone.join(found, everyone["id"].eqNullSafe(found["c0"]), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_found.select(
        F.col("id").alias(conv_col),
        *(F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
