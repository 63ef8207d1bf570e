"""Window plans against the loops that they stand for."""

import random

from pyspark.sql import functions as F

from docframe.operators import quality
from docframe.operators import questions as Q
from docframe.operators import structure as S


def stack_tree(levels):
    """(parent position, order among siblings, path) of each heading by a stack."""
    stack, counts, out = [], {}, []
    for i, level in enumerate(levels):
        while stack and stack[-1][1] >= level:
            stack.pop()
        parent = stack[-1][0] if stack else None
        counts[parent] = counts.get(parent, 0) + 1
        path = (out[parent][2] + "." if parent is not None else "") + str(counts[parent])
        out.append((parent, counts[parent], path))
        stack.append((i, level))
    return out


def test_tree_against_a_stack(spark):
    rng = random.Random(5)
    docs = {d: [rng.randrange(1, 7) for _ in range(rng.randrange(1, 25))] for d in range(60)}
    rows = [(d, i, v) for d, levels in docs.items() for i, v in enumerate(levels)]
    got = {(r.doc_id, r.block_idx): (r.parent_idx, r.ord, r.path) for r in S.tree(spark.createDataFrame(rows, "doc_id long, block_idx long, level long")).collect()}
    for d, levels in docs.items():
        assert [got[d, i] for i in range(len(levels))] == stack_tree(levels)


def test_bounds_and_flags(spark):
    texts = {1: "xSyEz", 2: "xyz", 3: "SxSyE", 4: "ES", 5: "SS"}
    rows = [(d, i, c) for d, t in texts.items() for i, c in enumerate(t)]
    df = spark.createDataFrame(rows, "doc_id long, block_idx long, text string")
    got = {r.doc_id: (r.first, r["last"], r.flags) for r in S.bounds(df, F.col("text") == "S", F.col("text") == "E").collect()}
    assert got == {
        1: (1, 3, ""), 2: (None, None, "THEORY_START_NOT_FOUND"), 3: (0, 4, "MULTIPLE_THEORY_HEADERS:2"), 4: (1, None, "THEORY_END_NOT_FOUND"),
        5: (0, None, "MULTIPLE_THEORY_HEADERS:2,THEORY_END_NOT_FOUND"),
    }


def test_segments(spark):
    said = ["pre", "LVL", "a question long enough", "Q1", "x", "Q2", "LVL", "short", "Q3"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(said)], "d int, i int, s string")
    got = Q.segments(df, F.col("s") == "LVL", F.col("s").startswith("Q"), F.length("s") > 10, "d", "i").orderBy("i")
    assert [(r.s, r.q_order) for r in got.collect()] == [("a question long enough", 1), ("Q1", 2), ("x", 2), ("Q2", 3), ("Q3", 4)]


def test_odd_one_out(spark):
    rows = [(1, "r", 1), (1, None, 2), (1, None, 3), (2, "r", 1), (2, "g", 2), (3, "r", 1), (3, "r", 2)]
    got = Q.odd_one_out(spark.createDataFrame(rows, "k int, c string, n int"), "k", "c", "n").collect()
    assert [tuple(r) for r in got] == [(1, 1)]


def test_gates(spark):
    base = {"words": 500, "figures": 0, "sections": 3, "n_starts": 1, "formulas": 10, "resolved": 10, "coverage": 1.0, "inline_bytes": 0}
    cases = [base, base | {"words": 10}, base | {"words": 10, "figures": 5}, base | {"resolved": 8}, base | {"sections": 0}, base | {"formulas": 0, "resolved": 0}]
    df = spark.createDataFrame([(i, *c.values()) for i, c in enumerate(cases)], ["id", *base])
    assert [r.status for r in quality.gates(df).orderBy("id").collect()] == ["PASS", "FAIL", "WARN", "WARN", "FAIL", "PASS"]


def test_quantile_of_any_spread(spark):
    import numpy as np

    from docframe.operators.quality import quantile

    rng = np.random.default_rng(3)
    for values in (rng.random(5000), np.r_[np.zeros(4000), rng.random(1000)], np.full(900, 7.0), np.arange(3.0), np.array([2.5])):
        rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        for q in (0.0, 0.5, 0.95, 1.0):
            assert abs(quantile(rows, "v", q, 100) - np.quantile(values, q)) < 1e-12
    assert quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None
