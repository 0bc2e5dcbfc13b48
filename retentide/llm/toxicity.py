"""Toxic passages as maximal scoring segments of token log-odds, with extreme-value statistics.

A token's score is its log-odds between toxic and clean documents under Dirichlet priors: the prior
mean of a token is its share of the whole corpus, moved by the rates of tokens with the same head
and length. Scores are shifted so that clean text drifts down. One linear scan (Ruzzo and Tompa)
finds all maximal scoring segments of a document. Their scores follow an extreme-value law in
clean text, with lambda and K fitted there, so a segment of score S in n tokens has the e-value
K * n * exp(-lambda * S). All significant ones are passages, however often their words come.

A document's evidence is the sum of -ln(e-value) over the segments of its damped scores that chance
doesn't explain, brought to a probability by a logistic fit. Repeats of a token are damped there, its
times in strong segments being the first ones; the damped scores have a lambda and K of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import WORDS, letters_inside, slices, words
from retentide.llm.sampling import labelled_sample, split_part

BUCKET_BITS = 17
HEAD_BYTES = 5
#: Labelled documents that scores are learned from, at most.
LABELLED_ROWS = 20000
#: What a score loses, so that clean text drifts down, and the most that it may lose.
DRIFT, LOWEST = 2.0, -3.0
SIGNIFICANT = 0.05


@dataclass(frozen=True)
class ToxicityModel:
    counts: np.ndarray  # (corpus, clean, toxic) by bucket of the token
    heads: np.ndarray  # the same by bucket of head and length
    decay: float  # lambda of the extreme-value law of damped scores, that evidence is measured by
    space: float  # its K
    passage_decay: float  # lambda and K of scores as they are, that passages are found by
    passage_space: float
    intercept: float
    slope: float

    def scores(self, tokens: np.ndarray, heads: np.ndarray, label: int | None = None) -> np.ndarray:
        """Shifted log-odds of tokens, by their buckets; for a document that was learned from, given its
        label, as if it hadn't been."""
        total, rest = self.counts.sum(axis=1, dtype=np.float64), self.heads.sum(axis=1, dtype=np.float64)
        share = (self.counts[0, tokens] + 1.0) / (total[0] + self.counts.shape[1])
        head_share = (self.heads[0, heads] + 1.0) / (rest[0] + self.heads.shape[1])
        strength = max(1.0, min(total[1], total[2]))
        sides = []
        for k in (1, 2):
            count, head, n, m = self.counts[k, tokens], self.heads[k, heads], total[k], rest[k]
            if label is not None and k == 1 + label:
                count, head, n, m = count - _own(tokens), head - _own(heads), n - len(tokens), m - len(heads)
            rate = (head + 1.0) / (m * head_share + 1.0)
            sides.append((count + strength * share * rate) / (n + strength))
        return np.maximum(np.log(sides[1] / sides[0]) - DRIFT, LOWEST)


def damped(scores: np.ndarray, tokens: np.ndarray, found: list[tuple[int, int, float]]) -> np.ndarray:
    """Scores of a text for its evidence: the k-th time that a token speaks for toxicity, it counts by
    1 / k**2, as repeats tell little. Times are told from the strongest of the segments `found` to the weakest,
    so mentions elsewhere take nothing from a passage."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return scores
    strength = np.zeros(len(scores))
    for first, end, score in found:
        strength[first:end] = score
    order = np.lexsort((at, -strength[at], tokens[at]))
    new = np.flatnonzero(np.diff(tokens[at][order], prepend=-1))
    times = np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at)))) + 1
    scores = scores.copy()
    scores[at[order]] /= times.astype(float) ** 2
    return scores


def _own(buckets: np.ndarray) -> np.ndarray:
    """How often each bucket is among the buckets."""
    _, place, times = np.unique(buckets, return_inverse=True, return_counts=True)
    return times[place]


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of their heads, and the offsets of each text's words."""
    inside = letters_inside(data)
    whole = words(data, at, WORDS, inside)
    head = words(data, at, WORDS, inside, head=HEAD_BYTES)
    shift = np.uint64(64 - BUCKET_BITS)
    return (whole.hashes >> shift).astype(np.int64), (head.hashes >> shift).astype(np.int64), whole.per_text(len(at) - 1)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(first, last + 1, score) of all maximal scoring segments, in order and apart from each other."""
    total = 0.0
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum after, nearest candidate with a lesser sum before
    for i, score in enumerate(scores):
        if score <= 0:
            total += score
            continue
        first, low = i, total
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((first, i + 1, low, total, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, high - low) for first, end, low, high, _ in found]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """The maximal scoring segments of a row of tokens; runs of one sign are scanned as one."""
    if not len(scores):
        return []
    edges = np.flatnonzero(np.diff(scores > 0, prepend=~(scores[:1] > 0)))
    if len(edges) == 1 and scores[0] <= 0:
        return []
    ends = np.append(edges[1:], len(scores))
    return [(int(edges[a]), int(ends[b - 1]), s) for a, b, s in maximal_segments(np.add.reduceat(scores, edges).tolist())]


def _count(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of tokens and heads: over all documents, and over the clean and the toxic ones of the sample."""
    labels = docs.sparkSession.sparkContext.broadcast({r["doc_id"]: r["label"] for r in sample.collect()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = labels.value, 1 << BUCKET_BITS
        total = np.zeros((2, 3, size), np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, _, data, at in slices(batch.column("text")):
                *both, bounds = _tokens(data, at)
                sides = np.repeat([known.get(x, -1) for x in ids[first : first + len(at) - 1]], np.diff(bounds))
                for kind, buckets in enumerate(both):
                    total[kind, 0] += np.bincount(buckets, minlength=size)
                    for side in (0, 1):
                        total[kind, 1 + side] += np.bincount(buckets[sides == side], minlength=size)
        used = np.flatnonzero(total.any(axis=(0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(x[used]) for x in total.reshape(6, size))], ["bucket", *"abcdef"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    found = rows.mapInArrow(scan, "bucket int, a long, b long, c long, d long, e long, f long").groupBy("bucket").agg(*(F.sum(c).alias(c) for c in "abcdef")).toPandas()
    total = np.zeros((6, 1 << BUCKET_BITS), np.int64)
    total[:, found["bucket"]] = found[list("abcdef")].to_numpy().T
    return total[:3], total[3:]


def _decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda * score)] = 1 under clean text."""
    low, high = 1e-3, 1e-3
    grown = lambda x: float((weights * np.exp(np.minimum(x * scores, 500.0))).sum())
    while high < 50 and grown(high) < 1:
        low, high = high, high * 1.5
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grown(middle) < 1 else (low, middle)
    return low


def _extreme_value(scores, times, found, n: int) -> tuple[float, float]:
    """lambda and K from clean texts: histograms of their scores, their segments' scores and n tokens in all."""
    scores, times = np.concatenate(scores.to_list()), np.concatenate(times.to_list())
    decay = _decay(scores, times / times.sum())
    found = np.sort(np.concatenate(found.to_list()))
    high = found[int(0.9 * len(found)) :] if len(found) else np.zeros(1)
    # of n tokens, K * n * exp(-lambda * x) segments reach x: the median over the upper tenth of the segments
    space = float(np.median(np.arange(len(high), 0, -1) * np.exp(np.minimum(decay * high, 500.0)) / max(n, 1)))
    return decay, max(space, 1e-9)


def _evidence(found: list[float], n: int, decay: float, space: float) -> float:
    return float(np.maximum(decay * np.array(found) - np.log(space * max(n, 1)), 0).sum()) if found else 0.0


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton's method on a slightly penalised likelihood."""
    design, beta = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * beta)
    return float(beta[0]), float(beta[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Learn from `labels` (doc_id, toxic) outside the held-out quarter and the texts of `docs`.

    Without a label of either class every document gets the share of toxic labels, or 0."""
    sample = labelled_sample(labels, "toxic", 4, 2, rows).cache()
    counts, heads = _count(docs, sample)
    model = ToxicityModel(counts, heads, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, last, data, at in slices(batch.column("text")):
                tokens, ends, bounds = _tokens(data, at)
                labels = batch.column("label").slice(first, last - first).to_pylist()
                cut = [slice(bounds[k], bounds[k + 1]) for k in range(last - first)]
                plain = [model.scores(tokens[c], ends[c], label) for c, label in zip(cut, labels, strict=True)]
                passages = [segments(x) for x in plain]
                own = [damped(x, tokens[c], p) for x, c, p in zip(plain, cut, passages, strict=True)]
                columns = [pa.array(labels, pa.int32()), pa.array(np.diff(bounds))]
                for rows, found in ((plain, passages), (own, [segments(x) for x in own])):
                    histogram = [np.unique(np.round(x, 1), return_counts=True) for x in rows]
                    columns += [
                        pa.array([[s for _, _, s in x] for x in found], pa.list_(pa.float64())),
                        pa.array([h[0] for h in histogram], pa.list_(pa.float64())),
                        pa.array([h[1] for h in histogram], pa.list_(pa.int64())),
                    ]
                yield pa.RecordBatch.from_arrays(columns, ["label", "n", *(f"{kind}{c}" for kind in ("passage_", "") for c in ("found", "score", "times"))])

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).join(F.broadcast(sample), "doc_id").select("label", "text")
    seen = rows_in.mapInArrow(scan, "label int, n long, " + ", ".join(f"{kind}found array<double>, {kind}score array<double>, {kind}times array<long>" for kind in ("passage_", ""))).toPandas()
    sample.unpersist()
    toxic = seen["label"].to_numpy() == 1
    if not toxic.any() or toxic.all():
        share = float(toxic.mean()) if len(toxic) else 0.0
        return ToxicityModel(counts, heads, 1.0, 1e12, 1.0, 1e12, 40.0 if share else -40.0, 0.0)
    clean = seen[~toxic]
    decay, space = _extreme_value(clean["score"], clean["times"], clean["found"], int(clean["n"].sum()))
    passage_law = _extreme_value(clean["passage_score"], clean["passage_times"], clean["passage_found"], int(clean["n"].sum()))
    evidence = np.array([_evidence(list(f), n, decay, space) for f, n in zip(seen["found"], seen["n"], strict=True)])
    intercept, slope = _logistic(np.log1p(evidence), toxic.astype(float))
    return ToxicityModel(counts, heads, decay, space, *passage_law, intercept, slope)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, passages) for each row of `docs` (doc_id, text).

    passages are the significant segments: first and last byte of the lower-cased text, score and
    e-value. NULL and empty texts have no evidence and get the score of such a text. Repeated rows are
    scored alike; other columns are ignored; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, last, data, at in slices(batch.column("text")):
                w = words(data, at, WORDS, letters_inside(data))
                tokens, heads, bounds = _tokens(data, at)
                scores = model.scores(tokens, heads)
                passages, out = [], np.zeros(last - first)
                for k in range(last - first):
                    lo, n = bounds[k], int(bounds[k + 1] - bounds[k])
                    mine = scores[lo : lo + n]
                    found = segments(mine)
                    out[k] = _evidence([s for _, _, s in segments(damped(mine, tokens[lo : lo + n], found))], n, model.decay, model.space)
                    values = [(a, b, s, model.passage_space * n * float(np.exp(-model.passage_decay * s))) for a, b, s in found]
                    passages.append([(int(w.starts[lo + a] - at[k]), int(w.ends[lo + b - 1] - at[k]), s, e) for a, b, s, e in values if e <= SIGNIFICANT])
                score = 1 / (1 + np.exp(-(model.intercept + model.slope * np.log1p(out))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(score), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    schema = "doc_id long, score double, passages array<struct<first: long, last: long, score: double, e_value: double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).mapInArrow(scan, schema)


def held_out(doc_id: F.Column) -> F.Column:
    return split_part(doc_id, 4) == 2
