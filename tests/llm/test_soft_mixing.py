import random

import numpy as np
import pytest

from retentide.llm import soft_mixing
from retentide.llm.soft_mixing import STAY, mix_documents

TARGETS = {"a": 0.5, "b": 0.3, "c": 0.2}


def corpus(seed=4, n=400):
    draw = random.Random(seed)
    words = {d: [f"{d}{i}x" for i in range(40)] for d in "abc"}
    rows = []
    for i in range(n):
        domain = draw.choices("abc", weights=[1, 6, 3])[0]
        rows.append((i, " ".join(draw.choices(words[domain] + words["a"][:5], k=draw.randrange(5, 80))), domain))
    return rows


def tables(spark, rows):
    return spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, d) for i, _, d in rows if i % 2], "doc_id long, domain string")


def test_expected_tokens_match_targets(spark):
    rows = corpus()
    got = mix_documents(*tables(spark, rows), TARGETS).collect()
    p, n, rate = np.array([r["posterior"] for r in got]), np.array([r["n_tokens"] for r in got]), np.array([r["rate"] for r in got])
    assert (rate >= 0).all() and (n == [len(dict((i, t) for i, t, _ in rows)[r["doc_id"]].split()) for r in got]).all()
    assert np.allclose((rate * n) @ p / n.sum(), [0.5, 0.3, 0.2], atol=0.005)
    truth = {i: d for i, _, d in rows}
    assert np.mean(["abc"[int(np.argmax(r["posterior"]))] == truth[r["doc_id"]] for r in got if r["doc_id"] % 2 == 0]) > 0.95


def test_rates_solve_the_problem(spark):
    """The conditions of a minimum: no gradient where the rate is positive, none downwards at zero."""
    draw = np.random.default_rng(2)
    p = draw.dirichlet([0.4, 0.4, 0.4], 300)
    n = draw.integers(1, 50, 300)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n_tokens long, posterior array<double>").repartition(4)
    steps = soft_mixing.fit_rates(df, ["a", "b", "c"], {"a": 0.8, "b": 0.15, "c": 0.05})
    rate, _ = soft_mixing.replay(p, steps)
    share = n / n.sum()
    gram = np.linalg.pinv((p * share[:, None]).T @ p)
    gradient = p @ gram @ ((rate * share) @ p - [0.8, 0.15, 0.05]) + STAY * (rate - 1)
    assert (rate == 0).any() and (rate > 1).any()
    assert np.abs(gradient[rate > 1e-9]).max() < 1e-3
    assert gradient[rate <= 1e-9].min() > -1e-3


@pytest.mark.parametrize("targets", [{}, {"a": 0.0}, {"nothing": 1.0}])
def test_no_target_leaves_rates(spark, targets):
    assert {r["rate"] for r in mix_documents(*tables(spark, corpus(n=30)), targets).collect()} == {1.0}


def test_edge_cases(spark):
    rows = corpus(n=60)
    docs, labelled = tables(spark, rows)
    extra = spark.createDataFrame([(None, None), (900, ""), (901, "...!"), (902, "a1x " * 100000), (902, "a1x " * 100000)], "doc_id long, text string")
    docs = docs.union(extra).selectExpr("*", "'x' AS rate", "1 AS domain", "2 AS label")
    labelled = labelled.union(spark.createDataFrame([(None, "a"), (5, None), (1, "b")], "doc_id long, domain string"))
    got = mix_documents(docs, labelled, TARGETS)
    assert got.columns == ["doc_id", "text", "domain", "label", "n_tokens", "posterior", "rate"]
    got = got.collect()
    assert len(got) == 65
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["n_tokens"], r["rate"]))
    assert {n for d in (None, 900, 901) for n, _ in by[d]} == {0} and len(by[902]) == 1
    assert mix_documents(docs.limit(0), labelled, TARGETS).collect() == []
    assert {r["rate"] for r in mix_documents(docs, labelled.limit(0), TARGETS).collect()} == {1.0}
