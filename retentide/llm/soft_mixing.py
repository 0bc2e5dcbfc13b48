"""Document rates that bring the expected tokens of soft domains to target weights.

A classifier learned from labelled documents gives each document a posterior over the domains. A
document's rate is the number of times it is read, in expectation. The rates solve the least squares

    1/2 e' inv(G) e + mu/2 sum_i n_i / T (rate_i - 1)^2,  rate_i >= 0,
    e = (sum_i rate_i n_i p_i - targets) / T,  G = sum_i n_i / T p_i p_i'

with n_i the tokens of document i, p_i its posterior and T all tokens. Projected gradient steps, in the
metric of the weights n_i / T and with momentum, only need the D sums of each round: a document's rate
is replayed from the rounds' multipliers, so a round is one aggregation over the corpus and nothing is
kept per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import WORDS, letters_inside, mix, slices, text_buffer, text_groups, words
from retentide.llm.spark_util import checkpoint

WORD_BITS, SHAPE_BITS = 16, 12
#: The sample that the classifier is fitted on: so many labelled documents, none of more bytes than this.
LABELLED_ROWS, LONGEST = 4000, 1 << 16
#: Passes over the sample, more of them if that gives fewer steps than this.
EPOCHS, STEPS, BATCH, RATE = 12, 400, 100, 0.2
#: The power of a text's words that the sum of their weights is divided by: between a sum and a mean.
POWER = 0.25
#: Weight of staying at rate 1; rounds at most; the change of a domain's share that ends them.
STAY, ROUNDS, TOLERANCE = 1e-3, 80, 1e-5


@dataclass(frozen=True)
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # bucket, domain
    bias: np.ndarray

    def posteriors(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of words and posterior of each text; the bias alone speaks for one without words."""
        word, shape, bounds = _buckets(data, at)
        counts = np.diff(bounds)
        logits = np.zeros((len(counts), len(self.domains)))
        full = np.flatnonzero(counts)
        if len(full):
            sums = np.add.reduceat(self.weights[word] + self.weights[shape], bounds[:-1][full], axis=0)
            logits[full] = sums / (counts[full] ** POWER)[:, None]
        logits += self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return counts, p / p.sum(axis=1, keepdims=True)


def _buckets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's bucket, the bucket of its shape (capitals, and what follows it), offsets by text."""
    w = words(data, at, WORDS, letters_inside(data))
    bounds = w.per_text(len(at) - 1)
    if not len(w.hashes):
        none = np.empty(0, np.int64)
        return none, none, bounds
    follows = np.append(data, [10, 10])
    last = at[w.texts + 1]
    after = np.where(w.ends < last, follows[w.ends], 10).astype(np.uint64)
    beyond = np.where(w.ends + 1 < last, follows[w.ends + 1], 10).astype(np.uint64)
    capital = lambda at: ((follows[at] >= 65) & (follows[at] <= 90)).astype(np.uint64)
    beyond = np.where((beyond >= 97) & (beyond <= 122) | (beyond >= 128), np.uint64(97), beyond)
    key = (after << np.uint64(16)) | (beyond << np.uint64(8)) | (capital(w.starts) << np.uint64(1)) | capital(w.starts + 1)
    shape = (mix(key + np.uint64(1)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << WORD_BITS)
    return (w.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), shape, bounds


def _all_buckets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of many texts, taken a group at a time to keep what is held small."""
    parts, counts = [(np.empty(0, np.int32), np.empty(0, np.int32))], [np.zeros(1, np.int64)]
    for first, last in text_groups(at):
        word, shape, bounds = _buckets(data[at[first] : at[last]], at[first : last + 1] - at[first])
        parts.append((word.astype(np.int32), shape.astype(np.int32)))
        counts.append(np.diff(bounds))
    word, shape = (np.concatenate(x) for x in zip(*parts, strict=True))
    return word, shape, np.cumsum(np.concatenate(counts))


def fit_classifier(data: np.ndarray, at: np.ndarray, y: np.ndarray, domains: list[str], seed: int = 3) -> DomainModel:
    """Softmax regression by AdaGrad over batches of texts."""
    size, k = (1 << WORD_BITS) + (1 << SHAPE_BITS), len(domains)
    share = (np.bincount(y, minlength=k) + 1.0) / (len(y) + k)
    weights, bias = np.zeros((size, k), np.float32), np.log(share)
    model = DomainModel(domains, weights, bias)
    squares, draw = np.full((size, k), 1e-3, np.float32), np.random.default_rng(seed)
    word, shape, bounds = _all_buckets(data, at)
    counts = np.diff(bounds)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(len(y), 1)))):
        order = draw.permutation(np.flatnonzero(counts))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            sizes = counts[rows]
            edges = np.concatenate([[0], np.cumsum(sizes)])
            place = np.arange(edges[-1]) + np.repeat(bounds[rows] - edges[:-1], sizes)
            both = np.concatenate([word[place], shape[place]])
            scale = 1 / sizes**POWER
            logits = np.add.reduceat(weights[word[place]] + weights[shape[place]], edges[:-1], axis=0) * scale[:, None] + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            each = np.tile(np.repeat(p * scale[:, None] / len(rows), sizes, axis=0), (2, 1))
            used, inverse = np.unique(both, return_inverse=True)
            grad = np.stack([np.bincount(inverse, weights=each[:, d], minlength=len(used)) for d in range(k)], axis=1) + 1e-6 * weights[used]
            squares[used] += (grad**2).astype(np.float32)
            weights[used] -= (RATE * grad / np.sqrt(squares[used])).astype(np.float32)
            bias -= 0.1 * p.mean(axis=0)
    return model


def fit_domains(docs: DataFrame, labelled: DataFrame, rows: int = LABELLED_ROWS) -> DomainModel:
    """Learn domains from `labelled` (doc_id, domain) and the texts of `docs`, from at most `rows` labelled
    documents by a hash of the id and whole texts of at most LONGEST bytes. NULLs don't count, of several
    domains of a document the least does. No labels give one domain, named `all`."""
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain")).dropna()
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    domains = sorted(r["domain"] for r in known.select("domain").distinct().collect()) or ["all"]
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= LONGEST)
    got = texts.join(F.broadcast(sample), "doc_id").orderBy("doc_id", "text").select("text", "domain").toArrow().combine_chunks()
    place = {name: k for k, name in enumerate(domains)}
    y = np.array([place[x] for x in got["domain"].to_pylist()], np.int64)
    data, at = text_buffer(got["text"].combine_chunks()) if got.num_rows else (np.empty(0, np.uint8), np.zeros(1, np.int64))
    return fit_classifier(data, at, y, domains)


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table (doc_id, quality, toxic): q0t0, q0t1, q1t0 or q1t1."""
    return labels.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain"))


def replay(p: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the rounds with these multipliers and momenta (round, domain + 1), and the points that
    the next gradient is asked for."""
    rate = ahead = np.ones(len(p))
    for step in steps:
        before, rate = rate, np.maximum(0, ahead - (p @ step[:-1] + STAY * (ahead - 1)) / (1 + STAY))
        ahead = rate + step[-1] * (rate - before)
    return rate, ahead


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def fit_rates(posteriors: DataFrame, domains: list[str], targets: dict[str, float]) -> np.ndarray:
    """The multipliers of the rounds for `posteriors` (n_tokens, posterior). Targets are weights of domains;
    they are scaled to one, a domain without a target gets none."""
    k = len(domains)
    want = np.array([max(0.0, targets.get(x, 0.0)) for x in domains])
    moments = [F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]
    first = posteriors.agg(F.sum("n_tokens").alias("total"), *moments).first()
    total = float(first["total"] or 0)
    if not total or not want.sum():
        return np.zeros((0, k + 1))
    want /= want.sum()
    gram = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            gram[i, j] = gram[j, i] = first[f"m{i}_{j}"] / total
    inverse = np.linalg.pinv(gram + 1e-9 * np.eye(k), hermitian=True)
    context = posteriors.sparkSession.sparkContext
    names = [*(f"s{i}" for i in range(k)), *(f"a{i}" for i in range(k)), "stay"]
    steps = np.zeros((0, k + 1))
    before, least, age = None, np.inf, 1.0
    for _ in range(ROUNDS):
        shared = context.broadcast(steps)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = np.zeros(2 * k + 1)
            for batch in batches:
                p, n = _matrix(batch.column("posterior"), k), batch.column("n_tokens").to_numpy()
                rate, ahead = replay(p, shared.value)
                found += np.concatenate([(rate * n) @ p, (ahead * n) @ p, [n @ (rate - 1) ** 2]])
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], names)

        parts = posteriors.select("n_tokens", "posterior").mapInArrow(sums, ", ".join(f"{c} double" for c in names))
        got = np.array(parts.agg(*(F.sum(c) for c in names)).first(), float) / total
        shared.unpersist()
        now, error = got[:k], got[:k] - want
        if before is not None and np.abs(now - before).max() < TOLERANCE:
            break
        # momentum starts anew when the objective rises
        objective = error @ inverse @ error + STAY * got[-1]
        age, last = (1.0, 1.0) if objective > least else ((1 + np.sqrt(1 + 4 * age * age)) / 2, age)
        before, least = now, objective
        steps = np.vstack([steps, [*(inverse @ (got[k : 2 * k] - want)), (last - 1) / age]])
    return steps


def domain_posteriors(docs: DataFrame, model: DomainModel, steps: np.ndarray | None = None) -> DataFrame:
    """All columns of `docs` (with text), and n_tokens, posterior and, with steps, rate. Columns of these
    names are replaced. NULL and empty texts have no tokens and the posterior of a text without words."""
    names = [c for c in docs.columns if c not in ("n_tokens", "posterior", "rate")]
    shared = docs.sparkSession.sparkContext.broadcast((model, steps))
    added = {"n_tokens": F.lit(0).cast("long"), "posterior": F.array(F.lit(0.0))} | ({} if steps is None else {"rate": F.lit(0.0)})
    schema = docs.select(*names).withColumns(added).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, steps = shared.value
        for batch in batches:
            for first, last, data, at in slices(batch.column("text")):
                n, p = model.posteriors(data, at)
                own = [batch.column(c).slice(first, last - first) for c in names if c != "__text"]
                new = [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))]
                if steps is not None:
                    new.append(pa.array(replay(p, steps)[0]))
                yield pa.RecordBatch.from_arrays([*own, *new], list(schema.names))

    return docs.select(*names, *([] if "text" in names else ["text"])).mapInArrow(scan, schema)


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], columns: list[str] | None = None) -> DataFrame:
    """`columns` of `docs` (all, if not given) with n_tokens, posterior (one number for each domain, in order
    of their names) and rate. Repeated rows get the same rate each and count each; an empty table gives no
    rows; rates are 1 where nothing is labelled, no target holds or no text has a word."""
    model = fit_domains(docs, labelled)
    seen = checkpoint(domain_posteriors(docs.select("text"), model).select("n_tokens", "posterior"))
    steps = fit_rates(seen, model.domains, targets)
    found = domain_posteriors(docs.select(*columns, *([] if "text" in columns else ["text"])) if columns else docs, model, steps)
    return found.select(*(columns or [c for c in docs.columns if c not in ("n_tokens", "posterior", "rate")]), "n_tokens", "posterior", "rate")
