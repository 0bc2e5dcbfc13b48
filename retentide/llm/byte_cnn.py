"""Quality of documents by a convolutional network over bytes, in numpy.

A text is padded with zero bytes to whole half-chunks. Bytes become small vectors; filters slide over
them (eight bytes wide, every fourth byte); each filter is max-pooled over every chunk of two
neighbouring half-chunks, so chunks overlap by half and cover the whole document. The mean and the
maximum over the chunks go through one hidden layer into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import slices
from retentide.llm.sampling import labelled_sample

DIM, FILTERS, HIDDEN = 8, 32, 24
STRIDE, WIDTH, HALF = 4, 8, 512
#: The sample that the network is fitted on: so many labelled documents, none of more bytes than this.
LABELLED_ROWS, LONGEST = 4000, 1 << 16
#: Passes over the sample, more of them if that gives fewer steps than this.
EPOCHS, STEPS, BATCH = 8, 800, 32


@dataclass
class ByteNet:
    """embed (256, DIM), near and far (STRIDE * DIM, FILTERS), then dense layers over mean and maximum."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> ByteNet:
        draw = np.random.default_rng(seed)
        scale = lambda *shape: (draw.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
        embed = draw.standard_normal((256, DIM)).astype(np.float32)
        embed[0] = 0
        return ByteNet(
            {
                "embed": embed,
                "near": scale(STRIDE * DIM, FILTERS),
                "far": scale(STRIDE * DIM, FILTERS),
                "bias": np.zeros(FILTERS, np.float32),
                "dense": scale(2 * FILTERS, HIDDEN),
                "dense_bias": np.zeros(HIDDEN, np.float32),
                "out": scale(HIDDEN, 1)[:, 0],
                "out_bias": np.zeros(1, np.float32),
            }
        )


def pad(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, each padded by STRIDE zero bytes at least, and the offsets of their half-chunks."""
    sizes = np.diff(at)
    halves = -(-(sizes + STRIDE) // HALF)
    bounds = np.concatenate([[0], np.cumsum(halves)])
    padded = np.zeros(int(bounds[-1]) * HALF + STRIDE, np.uint8)
    if len(data) < len(sizes) * 4096:
        padded[np.arange(len(data)) + np.repeat(bounds[:-1] * HALF - at[:-1], sizes)] = data
    else:
        for k in range(len(sizes)):
            padded[bounds[k] * HALF : bounds[k] * HALF + sizes[k]] = data[at[k] : at[k + 1]]
    return padded, bounds


def pooled_halves(net: ByteNet, padded: np.ndarray, bounds: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The maximum of each filter over each half-chunk, and where it is."""
    n = int(bounds[-1])
    w, out, at = net.weights, np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64) if places else None
    closing = np.zeros(n, bool)  # the last half-chunk of a text, whose last filter place must not see the next text
    closing[bounds[1:] - 1] = True
    step = 128  # half-chunks at once
    per = HALF // STRIDE
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        x = w["embed"][padded[lo * HALF : hi * HALF + STRIDE]].reshape(-1, STRIDE * DIM)
        ahead = (x[1:] @ w["far"]).reshape(hi - lo, per, FILTERS)
        ahead[closing[lo:hi], -1] = 0
        y = (x[:-1] @ w["near"]).reshape(hi - lo, per, FILTERS) + ahead
        if at is None:
            y.max(axis=1, out=out[lo:hi])
        else:
            best = y.argmax(axis=1)
            at[lo:hi] = best + (np.arange(lo, hi) * per)[:, None]
            out[lo:hi] = np.take_along_axis(y, best[:, None], axis=1)[:, 0]
    return np.maximum(out + w["bias"], 0), at


def _chunks(halves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pooled chunks, their offsets by text, and the first half-chunk of each."""
    counts = np.maximum(np.diff(bounds) - 1, 1)
    edges = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], counts)
    second = np.minimum(first + 1, np.repeat(bounds[1:] - 1, counts))
    return np.maximum(halves[first], halves[second]), edges, first


def forward(net: ByteNet, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probability of each text."""
    padded, bounds = pad(data, at)
    halves, _ = pooled_halves(net, padded, bounds)
    chunks, edges, _ = _chunks(halves, bounds)
    w = net.weights
    features = np.concatenate([np.add.reduceat(chunks, edges[:-1], axis=0) / np.diff(edges)[:, None].astype(np.float32), np.maximum.reduceat(chunks, edges[:-1], axis=0)], axis=1)
    hidden = np.maximum(features @ w["dense"] + w["dense_bias"], 0)
    return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0]).astype(np.float64)))


def gradients(net: ByteNet, data: np.ndarray, at: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of a batch and its gradient."""
    w = net.weights
    padded, bounds = pad(data, at)
    halves, places = pooled_halves(net, padded, bounds, places=True)
    chunks, edges, first = _chunks(halves, bounds)
    sizes = np.diff(edges)
    text = np.repeat(np.arange(len(sizes)), sizes)
    top = np.maximum.reduceat(chunks, edges[:-1], axis=0)
    features = np.concatenate([np.add.reduceat(chunks, edges[:-1], axis=0) / sizes[:, None].astype(np.float32), top], axis=1)
    before = features @ w["dense"] + w["dense_bias"]
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))
    loss = -np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-7))
    d_logit = ((p - y) / len(y)).astype(np.float32)
    grad = {"out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_hidden = np.outer(d_logit, w["out"]) * (before > 0)
    grad |= {"dense": features.T @ d_hidden, "dense_bias": d_hidden.sum(axis=0)}
    d_features = d_hidden @ w["dense"].T
    # neighbouring chunks share a half-chunk and so often the maximum
    equal = (chunks == top[text]).astype(np.float32)
    equal /= np.add.reduceat(equal, edges[:-1], axis=0)[text]
    d_chunks = (d_features[:, :FILTERS] / sizes[:, None])[text] + equal * d_features[text, FILTERS:]
    second = np.minimum(first + 1, np.repeat(bounds[1:] - 1, sizes))
    from_second = halves[second] > halves[first]
    d_halves = np.zeros_like(halves)
    np.add.at(d_halves, first, np.where(from_second, 0, d_chunks))
    np.add.at(d_halves, second, np.where(from_second, d_chunks, 0))
    d_halves *= halves > 0
    grad["bias"] = d_halves.sum(axis=0)
    # only the places of the maxima have a gradient
    half, f = np.nonzero(d_halves)
    g, place = d_halves[half, f], places[half, f] * STRIDE
    read = padded[place[:, None] + np.arange(WIDTH)]
    read[np.isin(place + STRIDE, bounds[1:] * HALF), STRIDE:] = 0
    x = w["embed"][read].reshape(len(g), WIDTH * DIM)
    kernel = np.concatenate([w["near"], w["far"]])
    by_filter = np.zeros((FILTERS, WIDTH * DIM), np.float32)
    np.add.at(by_filter, f, x * g[:, None])
    grad["near"], grad["far"] = by_filter.T[: STRIDE * DIM], by_filter.T[STRIDE * DIM :]
    d_x = (kernel.T[f] * g[:, None]).reshape(-1, DIM)
    grad["embed"] = np.stack([np.bincount(read.ravel(), weights=d_x[:, k], minlength=256) for k in range(DIM)], axis=1).astype(np.float32)
    grad["embed"][0] = 0
    return float(loss), grad


def fit_net(data: np.ndarray, at: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> ByteNet:
    """Adam over batches of whole texts; ends at the intercept alone where only one label is given."""
    net, draw = ByteNet.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    net.weights["out_bias"][:] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        net.weights["out"][:] = 0
        return net
    batches = -(-len(y) // BATCH)
    epochs = max(epochs, -(-STEPS // batches))
    steps, total, sizes = 0, epochs * batches, np.diff(at)
    for _ in range(epochs):
        order = draw.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo : lo + BATCH]
            part = np.concatenate([data[at[k] : at[k + 1]] for k in rows])
            _, grad = gradients(net, part, np.concatenate([[0], np.cumsum(sizes[rows])]), y[rows])
            steps += 1
            rate = 4e-3 * 0.5 * (1 + np.cos(np.pi * steps / (total + 1)))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.weights[k] -= (rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS) -> ByteNet:
    """Learn `label` of `labels` outside the held-out third, from at most `rows` whole texts of at most
    LONGEST bytes. No labels give a net that says one half."""
    sample = labelled_sample(labels, label, 3, 1, rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= LONGEST)
    got = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text").orderBy("doc_id", "text").toPandas()
    raw = [x.encode() for x in got["text"]]
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return fit_net(np.frombuffer(b"".join(raw), np.uint8), at, got["label"].to_numpy(np.float32))


def score_quality(docs: DataFrame, net: ByteNet) -> DataFrame:
    """(doc_id, score) for each row of `docs` (doc_id, text). NULL text counts as empty, which is one chunk
    of zero bytes. Repeated rows are scored alike; other columns are ignored; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, at in slices(batch.column("text"), 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(forward(shared.value, data, at))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, score double")
