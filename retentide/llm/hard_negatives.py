"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

Candidates are dealt into parts. A task holds one part: its integer vectors and, for each dimension, its
rows sorted by that component. Anchors stream by. For an anchor every list is read from the end that its
component's sign favours; rows that come up are scored at once from their whole vectors. The sum of the
anchor's components times the values at the current depth bounds every row that has not come up. Reading
stops once this bound falls strictly below the worst score that each window still needs (strictly, as a
row of an equal score and a smaller id would come first), or below the window itself.

Two passes: an anchor meets the parts of its own label for its positives, whose scores are the windows
that then go through all parts for rows of other labels. What the parts find is merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentide.llm.spark_util import checkpoint

#: Rows of a part, which a task holds whole, and the least number of parts, for small tables.
PART_ROWS, LEAST_PARTS = 1 << 15, 12
#: More labels than this aren't broadcast.
BROADCAST_LABELS = 100_000
#: Depth of the first step of sorted access; each step doubles the depth.
FIRST_DEPTH = 64
LONG = (1 << 63) - 1


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def integers(vectors: list[np.ndarray], scale: int) -> np.ndarray:
    """floor(scale * x) of the vectors' components as the rows of a matrix; shorter vectors end in zeros.

    Components are float64, which is exact, or Python integers where one is beyond 2**53."""
    width = max((len(v) for v in vectors), default=0)
    matrix = np.zeros((len(vectors), width))
    for row, v in zip(matrix, vectors, strict=True):
        row[: len(v)] = np.floor(scale * v.astype(np.float64))
    if np.abs(matrix).max(initial=0) < 2.0**53:
        return matrix
    return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)


def _whole(numbers: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return numbers if numbers.dtype == object else np.array([int(x) for x in numbers.ravel()], object).reshape(numbers.shape)


@dataclass
class SortedLists:
    """The rows of a part, by id, and for each dimension their order by its component."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    order: np.ndarray  # (dimension, place): rows by ascending component
    largest: float

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> SortedLists:
        by_id = np.argsort(ids, kind="stable")
        matrix = matrix[by_id]
        order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        return cls(ids[by_id], labels[by_id], matrix, np.ascontiguousarray(order), float(np.abs(matrix).max(initial=0)))

    def exact_for(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The matrix and anchor in numbers whose products and sums are exact: float64 below 2**53, else Python's."""
        most = self.largest * float(np.abs(anchor).max(initial=0)) * max(1, len(anchor))
        if self.matrix.dtype == object or anchor.dtype == object or most >= 2.0**53:
            return _whole(self.matrix), _whole(anchor)
        return self.matrix, anchor

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], keep: int, read: list[int] | None = None) -> list[list[tuple[int, int]]]:
        """For each window (low, high) of scores the `keep` best (score, row) among `allowed` rows: highest score
        first, then the smaller id. `read` takes the number of rows scored, for tests."""
        n, width = len(self.ids), min(self.matrix.shape[1], len(anchor))
        matrix, anchor = self.exact_for(anchor[:width])
        matrix = matrix[:, :width]
        used = np.flatnonzero(anchor != 0)
        weights = anchor[used]
        seen = np.zeros(n, bool)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, matrix.dtype), np.empty(0, np.int64)) for _ in windows]
        depth, step, scored = 0, FIRST_DEPTH, 0
        while depth < n and any(low <= high for low, high in windows):
            upto = min(n, depth + step) if len(used) else n
            # sorted access, from the upper end where the anchor is positive, else from the lower one
            fresh = np.zeros(n, bool)
            if len(used):
                for d, w in zip(used, weights, strict=True):
                    fresh[self.order[d, n - upto : n - depth] if w > 0 else self.order[d, depth:upto]] = True
            else:
                fresh[:] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh & allowed)
            scored += len(rows)
            # random access: whole vectors
            scores = matrix[rows] @ anchor
            if scores.dtype == object:
                scores = np.array([max(-LONG - 1, min(LONG, s)) for s in scores], object)
            for k, (low, high) in enumerate(windows):
                inside = (scores <= high) & (scores >= low)
                if len(best[k][0]) == keep:
                    inside &= scores >= best[k][0][-1]
                if inside.any():
                    s, r = np.concatenate([best[k][0], scores[inside]]), np.concatenate([best[k][1], rows[inside]])
                    order = np.lexsort((r, -s))[:keep]
                    best[k] = s[order], r[order]
            depth, step = upto, upto
            edge = np.where(weights.astype(float) > 0, n - depth, depth - 1)
            bound = (matrix[self.order[used, edge], used] * weights).sum()
            if all(bound < (s[-1] if len(s) == keep else low) for (low, high), (s, _) in zip(windows, best, strict=True) if low <= high):
                break
        if read is not None:
            read.append(scored)
        return [[(int(s), int(r)) for s, r in zip(*found, strict=True)] for found in best]


def _in_parts(candidates: DataFrame, asking: DataFrame, parts: int, find, schema: str, scale: int) -> DataFrame:
    """For each part, its candidates (part, vec_id, label, v) and then the anchors (part, vec_id, label, v, windows) that
    ask it; `find` gives the rows for one anchor. Anchors are never held: they stream past the part."""
    columns = ["part", "kind", "vec_id", "label", "v", "positives"]
    none = F.lit(None).cast("array<struct<positive_id:bigint,score:bigint>>")
    rows = candidates.select("part", F.lit(0).alias("kind"), "vec_id", "label", "v", none.alias("positives")).unionByName(
        asking.select("part", F.lit(1).alias("kind"), "vec_id", "label", "v", *(["positives"] if "positives" in asking.columns else [none.alias("positives")]))
    )
    rows = rows.select(columns).repartition(2 * parts, "part").sortWithinPartitions("part", "kind", "vec_id")
    names = [c.split()[0] for c in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lists, pending = None, None, []

        def built() -> SortedLists:
            ids, labels, vectors = (sum(x, []) for x in zip(*pending, strict=True)) if pending else ([], [], [])
            return SortedLists.build(np.array(ids, np.int64), np.array(labels, np.int64), integers(vectors, scale))

        for batch in filter(len, batches):
            parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.append(True, (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])))
            for lo, hi in zip(edges, np.append(edges[1:], len(parts)), strict=True):
                run = batch.slice(lo, hi - lo)
                if parts[lo] != part:
                    part, lists, pending = parts[lo], None, []
                ids, labels, vectors = run.column("vec_id").to_pylist(), run.column("label").to_pylist(), _vectors(run.column("v"))
                if kinds[lo] == 0:
                    pending.append((ids, labels, vectors))
                    continue
                lists = lists or built()
                found = []
                for i in range(len(ids)):
                    found += find(lists, ids[i], labels[i], integers(vectors[i : i + 1], scale)[0], run.column("positives")[i].as_py())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names)

    return rows.mapInArrow(scan, schema)


def mine_negatives(vectors: DataFrame, anchors: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, least_percent: int = 80, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` has (vec_id, label, embedding); `label` replaces its label, `anchors` says which rows are anchors. A score is
    the inner product of floor(scale * x) of two rows' components, in integers; higher scores come first, ties by the
    smaller vec_id. An anchor's positives are its first `positives` other rows of its label; for each, the first
    `negatives` rows of other labels whose score lies between `least_percent` % of the positive's score and that score.

    Rows with a NULL id, label or vector, or with a component that is NULL or not finite (also after scaling), take no part.
    Of several rows of one id the one of the least label, then the least vector, counts. Shorter vectors end in zeros; an
    empty one scores 0. A score beyond a long counts as the nearest long. A positive without
    negatives and an anchor without positives give no rows, and so does an empty table; other columns are ignored."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (label if label is not None else F.col("label")).cast("long").alias("label"),
        F.col("embedding").alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    scaled = lambda x: x.cast("double") * F.lit(float(scale))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(scaled(x)) & (F.abs(scaled(x)) < F.lit(math.inf)))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(fine, F.lit(False)))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v", "asked")).alias("r")).select("vec_id", "r.label", "r.v", "r.asked")
    rows = checkpoint(rows)
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART_ROWS)).cast("int")
    of_part = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    asking = rows.where("asked").drop("asked")

    # a label's parts; only labels with an anchor matter
    by_label = checkpoint(rows.groupBy("label").agg(F.count("*").alias("n"), F.max("asked").alias("asked")).where("asked").select("label", parts.alias("parts")))
    labels = by_label.agg(F.count("*").alias("n"), F.sum("parts").alias("parts")).first()
    own = lambda df: df.join(F.broadcast(by_label) if labels["n"] <= BROADCAST_LABELS else by_label, "label")
    name = lambda p: F.xxhash64("label", p)
    of_label = own(rows.drop("asked")).withColumn("part", name(of_part(F.col("parts"))))
    to_label = own(asking).withColumn("place", every(F.col("parts"))).withColumn("part", name(F.col("place")))

    def find_positives(lists: SortedLists, vec_id: int, label: int, vector: np.ndarray, _: None) -> list[tuple]:
        allowed = (lists.labels == label) & (lists.ids != vec_id)
        found = lists.search(vector, allowed, [(-math.inf, math.inf)], positives)[0]
        return [(vec_id, int(lists.ids[r]), s, k) for k, (s, r) in enumerate(found, 1)]

    found = _in_parts(of_label, to_label, labels["parts"] or 1, find_positives, "anchor_id long, positive_id long, score long, place long", scale)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    found = checkpoint(found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives")))

    size = rows.count()
    several = max(LEAST_PARTS, -(-size // PART_ROWS))
    of_all = rows.drop("asked").withColumn("part", of_part(F.lit(several)))
    to_all = asking.join(found.withColumnRenamed("anchor_id", "vec_id"), "vec_id").withColumn("part", every(F.lit(several)))

    def find_negatives(lists: SortedLists, vec_id: int, label: int, vector: np.ndarray, of: list[dict]) -> list[tuple]:
        windows = [(-(-least_percent * p["score"] // 100), p["score"]) for p in of]
        found = lists.search(vector, lists.labels != label, windows, negatives)
        return [(vec_id, p["positive_id"], int(lists.ids[r]), p["score"], s) for p, best in zip(of, found, strict=True) for s, r in best]

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = _in_parts(of_all, to_all, several, find_negatives, schema, scale)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
