import random

import numpy as np
import pytest

from retentide.llm import toxicity
from retentide.llm.sampling import split_part


def brute_segments(scores):
    """All maximal scoring segments by their recursive definition: the best segment, then both sides of it."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            # the shortest of equal ones, as a maximal segment has no prefix or suffix of score zero
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    a, b = at
    shift = lambda rows, k: [(x + k, y + k, s) for x, y, s in rows]
    return brute_segments(scores[:a]) + [(a, b, best)] + shift(brute_segments(scores[b:]), b)


@pytest.mark.parametrize("seed", range(40))
def test_segments_equal_the_definition(seed):
    draw = random.Random(seed)
    scores = [draw.choice([-1.5, -0.7, -0.3, 0.4, 0.9, 1.3]) * draw.uniform(0.5, 1.5) for _ in range(draw.randrange(40))]
    expected = brute_segments(scores)
    for got in (toxicity.maximal_segments(scores), toxicity.segments(np.array(scores))):
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in got], [s for *_, s in expected])


def corpus(n=300, seed=6):
    draw = random.Random(seed)
    clean = ["".join(draw.choices("aeioubcdfg", k=5)) for _ in range(200)]
    bad = ["grubble", "snorkface", "dimwort", "clodpole"]
    rows = []
    for i in range(n):
        words, toxic = draw.choices(clean, k=draw.randrange(20, 150)), draw.random() < 0.3
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = draw.choices(bad, k=3)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_documents_and_passages(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    held = toxicity.score_toxicity(docs, model).where(split_part(toxicity.F.col("doc_id"), 4) == 2).collect()
    text, truth = {i: t for i, t, _ in rows}, {i: y for i, _, y in rows}
    assert len(held) > 40
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.97
    hit = [text[r["doc_id"]].lower().encode()[p["first"] : p["last"]].decode() for r in held if truth[r["doc_id"]] for p in r["passages"]]
    assert sum(any(b in h for b in ("grubble", "snorkface", "dimwort", "clodpole")) for h in hit) > 0.8 * len(hit) > 0


def test_edge_cases(spark):
    rows = corpus(80)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(None, None, 0.1), (900, "", 0.1), (901, "grubble dimwort " * 50000, 0.1), (901, "..!", 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (0, rows[0][2])], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == 84 and all(0 <= r["score"] <= 1 for r in got)
    by = {(r["doc_id"], len(r["passages"]) > 0): r["score"] for r in got[80:]}
    assert by[901, True] > 0.9 and by[None, False] == by[900, False] == by[901, False] < 0.3
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []
    nothing = toxicity.fit_toxicity(docs, labels.limit(0))
    assert {round(r["score"]) for r in toxicity.score_toxicity(docs, nothing).collect()} == {0}


def test_passages_that_share_words_in_a_long_text(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    clean = [w for i, t, y in rows if not y for w in t.split()]
    bad = "grubble snorkface dimwort clodpole"
    filler = lambda k: " ".join(clean[k * 200 : k * 200 + 200])
    several = " ".join(f"{filler(k)} {bad}" for k in range(6)) + f" {filler(6)}"
    # lone mentions first, far apart, then a passage
    lone = " ".join(f"{filler(k)} {w}" for k, w in enumerate(bad.split() * 2))
    late, early = f"{lone} {filler(8)} {bad} {filler(9)}", f"{filler(8)} {bad} {filler(9)} {lone}"
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(spark.createDataFrame([(1, several), (2, late), (3, early)], "doc_id long, text string"), model).collect()}
    assert sum(bad in several[p["first"] : p["last"]] for p in got[1]["passages"]) == 6
    assert any(bad in late[p["first"] : p["last"]] for p in got[2]["passages"])
    assert abs(got[2]["score"] - got[3]["score"]) < 0.05 and got[2]["score"] > 0.5


def test_repeats_are_damped_from_the_strongest_segment_on():
    scores, tokens = np.array([2.0, -9.0, 2.0, 3.0]), np.array([5, 6, 5, 7])
    assert toxicity.damped(scores, tokens, toxicity.segments(scores)).tolist() == [0.5, -9.0, 2.0, 3.0]
