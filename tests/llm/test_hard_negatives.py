import math
import random

import numpy as np

from retentide.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10):
    """From the definition, with Python integers."""
    fine = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        fine[i] = min(fine.get(i, (math.inf, None)), ((label + 1) % 10 if i % 7 == 0 else label, q))
    out = []
    for a, (label, q) in fine.items():
        if a % every:
            continue
        score = lambda other: max(-hn.LONG - 1, min(hn.LONG, sum(x * y for x, y in zip(q, other, strict=False))))
        order = sorted((-score(w), i) for i, (_, w) in fine.items() if i != a)
        for p, i in [(-s, i) for s, i in order if fine[i][0] == label][:5]:
            near = [(-s, j) for s, j in order if fine[j][0] != label and 80 * p <= -100 * s <= 100 * p][:5]
            out += [(a, i, k, j, p, s) for k, (s, j) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, every=10):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS kind", "2 AS score")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS bigint) + 1) % 10 ELSE label END")
    found = hn.mine_negatives(df, F.col("vec_id") % every == 0, label)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def cloud(n=400, width=6, seed=2, labels=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    return [(i, (centres[i % 12] + 0.3 * draw.normal(size=width)).astype(np.float32).tolist(), int(draw.integers(labels))) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    rows = cloud()
    rows += [(401, None, 1), (402, rows[0][1], None), (403, [1.0, None], 2), (404, [math.nan] * 6, 1), (405, [math.inf] * 6, 0), (None, rows[1][1], 1)]
    rows += [(410, [0.0] * 6, 1), (420, [], 2), (411, [1.0, 2.0], 1), (412, rows[30][1], 3), (413, rows[30][1], 3), (430, [1.0] * 9, 3)]
    rows += rows[:20]
    want = brute(rows)
    assert len(want) > 300
    assert mined(spark, rows) == want
    monkeypatch.setattr(hn, "PART_ROWS", 16)  # many parts
    assert mined(spark, rows) == want


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 1.0], 0 if i < 12 else 1) for i in range(100, 125)] + [(i, [1.0, 1.0], 1) for i in range(24)]
    assert mined(spark, rows) == brute(rows)


def test_huge_components_are_exact(spark):
    rows = [(i, [float(np.float32(x * 1e12)) for x in v], label) for i, v, label in cloud(60, 3)]
    want = brute(rows)
    assert mined(spark, rows) == want and hn.LONG in {w[4] for w in want}


def test_empty_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_reading_stops_early():
    """On vectors with structure most rows aren't scored, and the answer is that of all rows."""
    draw = random.Random(4)
    ids = np.arange(3000)
    matrix = np.array([[draw.paretovariate(1.5) * 100 // 1 for _ in range(4)] for _ in ids])
    lists = hn.SortedLists.build(ids, np.zeros(3000, np.int64), matrix)
    read: list[int] = []
    for k in range(20):
        anchor = matrix[k] * np.array([1, -1, 1, 0])
        scores = matrix @ anchor
        order = sorted((-s, i) for i, s in enumerate(scores.tolist()))
        top = -order[3][0]
        found = lists.search(anchor, np.ones(3000, bool), [(-math.inf, math.inf), (0.5 * top, 0.9 * top)], 5, read)
        assert found[0] == [(int(-s), i) for s, i in order][:5]
        assert found[1] == [(int(-s), i) for s, i in order if 0.5 * top <= -s <= 0.9 * top][:5]
    assert sum(read) / len(read) < 1500
