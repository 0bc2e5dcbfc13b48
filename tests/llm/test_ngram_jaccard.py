import random

import pytest

from retentide.llm import ngram_jaccard
from retentide.llm.ngram_jaccard import similar_components


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                same = len(sets[i] & sets[j])
                if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def found(docs):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar_components(docs).collect())


def corpus(seed, n_bases, copies):
    """Copies of bases with so many words changed that similarities lie on both sides of the threshold."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=40)
    rows = []
    for _ in range(n_bases):
        base = draw.choices(vocabulary, k=draw.choice([3, 12, 40, 90, 140]))
        if draw.random() < 0.4:
            base += passage
        for _ in range(draw.randrange(1, copies)):
            words = list(base)
            for _ in range(draw.randrange(0, 5)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words = words[: max(1, int(len(words) * draw.uniform(0.75, 1)))]
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, make_docs, monkeypatch, small):
    if small:  # many blocks, leaders and frequent shingles
        monkeypatch.setattr(ngram_jaccard, "BLOCK_ROWS", 3)
        monkeypatch.setattr(ngram_jaccard, "LEADERS_EVERY", 2)
        monkeypatch.setattr(ngram_jaccard, "LOCALLY_FREQUENT", 2)
    rows = corpus(3, 25, 14)
    assert found(make_docs(rows).repartition(4)) == brute(rows)


def test_edge_cases(spark, make_docs):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "one two"), (9, "ONE  two"), (10, "one two three"), (11, long), (12, long + " y"), (3, "a b c d e f"), (3, "a b c d e f")]
    rows += [(20, "É b c d e"), (21, "é b c d e"), (22, "a b c d e f"), (23, "a b c d e f ")]
    assert found(make_docs(rows)) == brute(rows)
    assert found(make_docs([])) == []


def test_null_ids_and_other_columns(spark):
    rows = [(None, "a b c d e f g", 1, 2), (4, "a b c d e f g", 1, 2), (None, None, 1, 2), (None, "q r s t u v", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, component long")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar_components(docs).collect()}
    assert got == {(None, 3, 4), (4, 3, 4), (None, 0, None), (None, 2, None)}


def test_components_of_a_long_chain(spark):
    from retentide.llm.components import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (100, 100), (100, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}
    assert connected_components(edges.where("a < 0")).collect() == []


def test_null_ids_link_others(spark):
    base = [f"w{k}" for k in range(60)]
    near = lambda a, b: 100 * len(shingles(a) & shingles(b)) >= 80 * len(shingles(a) | shingles(b))
    first, bridge, last = " ".join(base), " ".join(base[7:] + ["y"]), " ".join(base[14:] + ["y"])
    assert near(first, bridge) and near(bridge, last) and not near(first, last)
    rows = [(7, first), (None, bridge), (None, bridge), (3, last)]
    got = similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    # brute force with ids beyond the others in place of NULL
    expected = brute([(1000 if i is None else i, t) for i, t in rows])
    assert sorted((1000 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected
    assert {r["component_id"] for r in got} == {3}


@pytest.mark.parametrize("seed", [5, 6])
def test_null_ids_equal_brute_force(spark, seed):
    rows = [(None if i % 2 else i, t) for i, t in corpus(seed, 15, 12)]
    got = similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    expected = brute([(10**9 if i is None else i, t) for i, t in rows])
    fill = lambda x: 10**9 if x is None else x
    assert sorted((fill(r["doc_id"]), r["n_shingles"], fill(r["component_id"])) for r in got) == expected


def test_sketches_never_differ_in_more_places_than_the_sets():
    import numpy as np

    draw = np.random.default_rng(4)
    for _ in range(60):
        pool = np.unique(draw.integers(0, 1 << 63, 900).astype(np.uint64))
        sets = [np.sort(draw.choice(pool, draw.integers(1, len(pool)), replace=False)) for _ in range(2)]
        bounds = np.array([0, len(sets[0]), len(sets[0]), len(sets[0]) + len(sets[1])])
        a, empty, b = ngram_jaccard.parity_sketches(np.concatenate(sets), bounds)
        assert empty == b"" and ngram_jaccard.sketch_distance(a, a) == 0
        apart = len(np.setxor1d(*sets))
        assert ngram_jaccard.sketch_distance(a, b) <= apart
        assert (ngram_jaccard.sketch_distance(a, b) - apart) % 2 == 0


def test_far_pairs_are_ruled_out_in_the_join(spark, monkeypatch):
    import numpy as np

    base = [f"w{k}" for k in range(200)]
    texts = [base, base[:160] + [f"x{k}" for k in range(40)], base[:194] + [f"y{k}" for k in range(6)]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    described = ngram_jaccard.describe_sets(docs, 5).where("shingle IS NULL").cache()
    node = {r["doc_id"]: r["node"] for r in described.collect()}
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lists = ngram_jaccard.shared_postings(ngram_jaccard.postings(docs, 5, 80, nothing), 80)
    alone = spark.createDataFrame([], "node long, component long")

    def joined():
        found = ngram_jaccard.cross_pairs(lists, alone, 80, described.select("node", "n", "sketch"))
        return {frozenset((r["a"], r["b"])) for r in found.collect()}

    near, far = frozenset((node[0], node[2])), frozenset((node[0], node[1]))
    assert joined() == {near}
    monkeypatch.setattr(ngram_jaccard, "JOINED_SETS", 0)  # no sketches
    assert joined() >= {near, far}
