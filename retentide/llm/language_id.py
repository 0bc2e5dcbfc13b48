"""Language of documents as a mixture: expectation-maximisation over words scored by byte n-grams.

A word's likelihood in a language is the product over its bytes of the probability of the byte with
its two neighbours (a blank at either end of the word). A document is a mixture of languages, each
word drawn from one of them. EM estimates the proportions; then languages leave the set one by one
as long as the penalised likelihood, log L - languages * ln(words) / 2, doesn't fall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import GROUP_BYTES, WORDS, letters_inside, slices, words
from retentide.llm.sampling import split_part

BUCKET_BITS = 16
#: Rows of each language that the n-gram counts are taken from, in expectation: the bound of the sample.
ROWS_PER_LANGUAGE = 5000
SMOOTHING = 0.5
#: The most that one word may speak against a language, in nats.
WORD_LIMIT = 10.0


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray  # language, bucket


def _grams(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Bucket of each byte inside a word, with its neighbours."""
    blank = np.where(inside, data, 32).astype(np.uint32)
    before = np.empty_like(blank)
    before[:1] = 32
    before[1:] = blank[:-1]
    after = np.empty_like(blank)
    after[-1:] = 32
    after[:-1] = blank[1:]
    edges = at[(at > 0) & (at < len(data))]
    before[edges] = 32
    after[edges - 1] = 32
    keys = (before[inside] << np.uint32(16)) | (blank[inside] << np.uint32(8)) | after[inside]
    return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def _inside(data: np.ndarray) -> np.ndarray:
    """Letters only: digits end a word."""
    return letters_inside(data) & ~((data >= 48) & (data <= 57))


def fit_languages(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Learn n-gram probabilities from `docs` (doc_id, text, lang); rows without a language don't count.

    Rows are picked by a hash of the id at a rate that gives about `rows` of each language. No rows
    give a model of no language."""
    docs = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    counted = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counted)
    if not languages:
        return LanguageModel([], np.zeros((0, 1 << BUCKET_BITS), np.float32))
    rates = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, rows / counted[name]))))
    index = F.create_map(*(F.lit(x) for k, name in enumerate(languages) for x in (name, k)))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) < rates[F.col("lang")] * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            which = batch.column("which").to_numpy()
            for first, last, data, at in slices(batch.column("text")):
                inside = _inside(data)
                grams = _grams(data, at, inside)
                edges = np.concatenate([[0], np.cumsum(inside)])[at]
                for k in range(last - first):
                    total[which[first + k]] += np.bincount(grams[edges[k] : edges[k + 1]], minlength=1 << BUCKET_BITS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket])], ["which", "bucket", "n"])

    rows_in = chosen.select(index[F.col("lang")].alias("which"), F.lower("text").alias("text"))
    found = rows_in.mapInArrow(count, "which int, bucket int, n long").groupBy("which", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((len(languages), 1 << BUCKET_BITS), SMOOTHING)
    total[found["which"], found["bucket"]] += found["n"]
    return LanguageModel(languages, np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32))


def _em(like: np.ndarray, bounds: np.ndarray, theta: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text, none of which is without words, and its log-likelihood."""
    sizes = np.diff(bounds)
    for _ in range(rounds):
        part = like * np.repeat(theta, sizes, axis=0)
        part /= np.maximum(part.sum(axis=1, keepdims=True), np.float32(1e-30))
        theta = np.add.reduceat(part, bounds[:-1], axis=0) / sizes[:, None].astype(np.float32)
    given = np.einsum("ij,ij->i", like, np.repeat(theta, sizes, axis=0))
    return theta, np.add.reduceat(np.log(np.maximum(given, np.float32(1e-30)), dtype=np.float64), bounds[:-1])


def _pick(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of the chosen texts, and their offsets."""
    sizes = np.diff(bounds)[rows]
    new = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(new[-1]) + np.repeat(bounds[rows] - new[:-1], sizes), new


def mixtures(data: np.ndarray, at: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Language proportions of each (lower-cased) text; equal where it has no word."""
    n, k = len(at) - 1, len(model.languages)
    theta = np.full((n, k), 1 / k, np.float32)
    inside = _inside(data)
    w = words(data, at, WORDS, inside)
    if not len(w.hashes):
        return theta
    grams = _grams(data, at, inside)
    first = np.cumsum(w.ends - w.starts) - (w.ends - w.starts)
    like = np.stack([np.add.reduceat(row[grams], first) for row in model.log_p], axis=1)
    like = np.exp(np.maximum(like - like.max(axis=1, keepdims=True), -np.float32(WORD_LIMIT)))
    bounds = w.per_text(n)
    rows = np.flatnonzero(np.diff(bounds))
    at_words, bounds = _pick(rows, bounds)
    like = like[at_words]
    sizes = np.diff(bounds)
    part, fit = _em(like, bounds, theta[rows], 8)
    theta[rows] = part
    alive = np.ones(part.shape, bool)
    trying = np.arange(len(rows))
    while len(trying):
        trying = trying[alive[trying].sum(axis=1) > 1]
        if not len(trying):
            break
        weakest = np.where(alive[trying], theta[rows[trying]], np.inf).argmin(axis=1)
        start = theta[rows[trying]].copy()
        start[np.arange(len(trying)), weakest] = 0
        start /= np.maximum(start.sum(axis=1, keepdims=True), np.float32(1e-30))
        at_words, some = _pick(trying, bounds)
        part, less = _em(like[at_words], some, start, 3)
        better = less - fit[trying] >= -0.5 * np.log(np.maximum(sizes[trying], 2))
        gone = trying[better]
        alive[gone, weakest[better]] = False
        theta[rows[gone]] = part[better]
        fit[gone] = less[better]
        trying = gone
    return theta


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of `docs` (with text), and lang_pred, score, shares.

    lang_pred is the language of the greatest share (ties go to the lesser name), score that share,
    shares the map of the selected languages. Text that is NULL or has no letter is `und` with score 0
    and no shares, as is every text under a model of no language. Columns of these names are replaced;
    repeated rows are scored alike."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "shares")
    names = docs.columns
    rows = docs.withColumn("__lower", F.lower("text")).withColumn("__letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.create_map(F.lit(""), F.lit(0.0)).alias("shares")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.languages)
        limit = max(1 << 16, 4 * GROUP_BYTES // max(4, k))
        for batch in batches:
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            theta = np.zeros((batch.num_rows, max(k, 1)), np.float32)
            for first, last, data, at in slices(batch.column("__lower"), limit):
                if k:
                    theta[first:last] = mixtures(data, at, model)
            best = theta.argmax(axis=1)
            known = letters & (k > 0)
            score = np.where(known, np.minimum(theta[np.arange(len(best)), best], 1), 0).astype(np.float64)
            pred = [model.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
            shares = [[(model.languages[j], float(theta[i, j])) for j in np.flatnonzero(theta[i] > 0.001)] if known[i] else [] for i in range(len(best))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array(pred, pa.string()), pa.array(score), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                [*names, "lang_pred", "score", "shares"],
            )

    return rows.mapInArrow(scan, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that the language model may learn from: outside the held-out quarter."""
    return docs.where(split_part(F.col("doc_id"), 4) != 2)
