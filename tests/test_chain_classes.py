"""Classes, periods and long-run shares against dense solutions."""

import numpy as np
import pytest

from yardstar.plans import chain_classes as K

SCHEMA = "patio_origem string, patio_destino string, probabilidade decimal(7,4)"


def chain(spark, moves):
    moves = [(a, b, float(w)) for a, b, w in moves]
    return spark.createDataFrame(moves, "o string, d string, p double").selectExpr(
        "o AS patio_origem", "d AS patio_destino", "CAST(p AS decimal(7,4)) AS probabilidade"
    )


def classes(df):
    return {r.patio: (r.classe, r.fechada, r.periodo) for r in K.communicating_classes(df).collect()}


def test_periodic_chain_has_a_forecast(spark):
    df = chain(spark, [("A", "B", 1), ("B", "C", 1), ("C", "A", 0.5), ("C", "D", 0.5), ("D", "E", 1), ("E", "C", 1)])
    # Cycles of 3 and 3 moves through C.
    assert classes(df) == {y: ("A", True, 3) for y in "ABCDE"}
    got = {r.patio: float(r.parcela) for r in K.long_run_shares(df).collect()}
    p = np.zeros((5, 5))
    for a, b, w in [(0, 1, 1), (1, 2, 1), (2, 0, 0.5), (2, 3, 0.5), (3, 4, 1), (4, 2, 1)]:
        p[a, b] = w
    lhs = np.vstack([p.T - np.eye(5), np.ones(5)])
    pi = np.linalg.lstsq(lhs, np.array([0, 0, 0, 0, 0, 1.0]), rcond=None)[0]
    assert [got[y] for y in "ABCDE"] == pytest.approx(list(pi), abs=2e-6)


def test_split_chain_leaks_into_its_closed_classes(spark):
    df = chain(
        spark,
        [("A", "B", 0.5), ("A", "C", 0.5), ("B", "A", 0.3), ("B", "E", 0.7), ("C", "D", 1), ("D", "C", 1), ("T", "A", 1)],
    )
    got = K.communicating_classes(df).cache()
    assert {r.patio: (r.classe, r.fechada, r.periodo) for r in got.collect()} == {
        "A": ("A", False, 2),
        "B": ("A", False, 2),
        "C": ("C", True, 2),
        "D": ("C", True, 2),
        "E": ("E", True, 1),  # nothing leaves it
        "T": ("T", False, None),
    }
    shares = {(r.patio, r.classe): float(r.parcela) for r in K.absorption_shares(df, got).collect()}
    dense = np.linalg.solve(np.eye(2) - np.array([[0, 0.5], [0.3, 0]]), np.array([[0.5, 0], [0, 0.7]]))
    for i, yard in enumerate("AB"):
        assert [shares[yard, "C"], shares[yard, "E"]] == pytest.approx(list(dense[i]), abs=2e-6)
    assert shares["T", "C"] == shares["A", "C"] and shares["D", "C"] == shares["E", "E"] == 1


def test_loops_nulls_and_empty(spark):
    df = chain(spark, [("A", "A", 0.2), ("A", "B", 0.8), ("B", "A", 1), (None, "B", 1), ("B", None, 1), ("B", "Z", 0)])
    assert classes(df) == {"A": ("A", True, 1), "B": ("A", True, 1)}
    empty = spark.createDataFrame([], SCHEMA)
    assert classes(empty) == {} and K.long_run_shares(empty).count() == 0
