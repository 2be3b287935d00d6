"""Hard negatives against the registered SQL and a plain version; the tree's elimination."""

import math
import random

import numpy as np
from odd_rows import SMALL

import __spark_entry__ as driver
from verification.check import differences, duck, duck_rows, spark_rows
from waterline.llm import blocks, negatives

DDL = "vec_id long, embedding array<double>, label int, rid string, leaf string, block string, low string"


def test_against_sql(spark):
    got = spark_rows(driver.queries()["op11_negatives"](spark, SMALL))
    assert differences(got, duck_rows(duck(SMALL), driver.oracle_sql()["op11_negatives"])) == []


def plain(rows, every):
    usable = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for at, (i, q, label) in enumerate(usable):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0, other) for k, (j, v, other) in enumerate(usable) if k != at and len(v) == len(q)]
        scored.sort(key=lambda s: s[:3])
        for score, none, j, _ in [s for s in scored if s[3] == label][:5]:
            inside = [s for s in scored if s[3] != label and -50 * score <= -100 * s[0] <= -95 * score]
            out += [(i, None if none else j, rank + 1, None if s[1] else s[2], -score, -s[0]) for rank, s in enumerate(inside[:3])]
    return sorted(out, key=str)


def test_odd_vectors(spark):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1.0, 0.5, 0.25, 2.0]) for _ in range(6)], draw.randrange(3)) for i in range(0, 300)]
    rows += [(100, [1.0] * 6, 1), (100, [1.0] * 6, 1), (200, None, 1), (250, [1.0] * 6, None), (300, [float("nan")] * 6, 1), (350, [None] * 6, 1)]
    rows += [(400, [math.inf] * 6, 1), (None, [2.0] * 6, 1), (None, [1.0] * 6, 2), (450, [], 1), (451, [], 1), (452, [], 2)]
    rows += [(500, [1.0, 3.0], 1), (501, [1.0, 2.0], 1), (502, [1.0, 2.0], 2), (503, [2.0, 1.0], 2), (550, [0.0] * 6, 1)]
    given = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], DDL).repartition(5)
    got = [tuple(r) for r in negatives.mine(given).collect()]
    assert sorted(got, key=str) == plain(rows, 50)
    assert negatives.mine(given.limit(0)).count() == 0


def test_levels_blocks_and_shares_change_nothing(spark, monkeypatch):
    """A deeper tree, leaves in several blocks and blocks in several copies give the same rows."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 8))
    vectors = [(centres[i % 12] + draw.normal(size=8) * 0.2).tolist() for i in range(600)]
    rows = [(i, v, int(i % 12 % 5)) for i, v in enumerate(vectors)]
    given = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], DDL).repartition(3)
    for module, name, value in ((negatives, "LEAF_ROWS", 10), (negatives, "BLOCK_ROWS", 5), (negatives, "SAMPLE_ROWS", 100), (blocks, "QUERY_SHARE", 4), (blocks, "AT_ONCE", 2)):
        monkeypatch.setattr(module, name, value)
    assert sorted((tuple(r) for r in negatives.mine(given, every=10).collect()), key=str) == plain(rows, 10)


def test_elimination_loses_no_row():
    draw = np.random.default_rng(1)
    rows = np.floor(256 * (draw.normal(size=(30, 6)).repeat(100, axis=0) + draw.normal(size=(3000, 6)) * 0.05))
    tree = negatives.Tree(rows[draw.permutation(3000)[:500]], 3)
    tree.widen(rows)
    leaf = tree.leaves(rows)
    queries = rows[::50]
    scores = queries @ rows.T
    high = np.sort(scores, axis=1)[:, [-1, -40]]
    low = np.sort(scores, axis=1)[:, [-6, -60]]
    sent = tree.meet(queries, low, high)
    asked = 0
    for q in range(len(queries)):
        wanted = {int(leaf[x]) for w in range(2) for x in np.flatnonzero((scores[q] >= low[q, w]) & (scores[q] <= high[q, w]))}
        reached = {n for n, found in enumerate(sent) if q in found}
        assert wanted <= reached
        asked += sum((leaf == n).sum() for n in reached)
    # on clustered rows most are never compared
    assert asked < 0.5 * len(queries) * len(rows)
