"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that makes all of them equally long, so the largest inner product is
the least distance. Centroids come from a balanced k-means of a bounded sample; they are searched by
a graph of their nearest neighbours, which every task holds. A vector goes to its nearest centroid's
list and, at a boundary, to further lists about as near that lie in other directions. A query reads
the lists whose centroids are at most `ratio` times as far as the nearest one (or as that usually is,
for a query that happens to lie on a centroid), and the few nearest ones in any case; both are fitted on
the sample. Scores are then computed exactly on the original vectors.

Vectors move once: they are dealt out by list and stored as blocks of rows in the shared folder. Queries are
stored as blocks, too, with the lists that they read. Each pair of blocks meets where the query's best so far
are held, so nothing is written per pair of query and list.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentide.llm.sampling import cut_by_hash
from retentide.llm.spark_util import checkpoint, flag_keys

#: The sample that centroids and the ratio are fitted on: so many vectors at most, picked by hash.
SAMPLE_ROWS = 40000
LIST_ROWS, SAMPLE_PER_CENTROID = 200, 16
DEGREE, BOUNDARY, REPLICAS, BREADTH = 16, 1.1, 8, 32
#: Share of the sample's true neighbours whose lists the ratio must reach.
REACH = 0.998
#: Share of them that the nearest lists must reach that every query reads, however the distances are.
REACH_BY_RANK = 0.9
#: Rows of a block of vectors, fewer if it takes more than BLOCK_BYTES, and of a block of queries in the mean.
BLOCK_ROWS, BLOCK_BYTES, QUERY_ROWS = 4096, 1 << 22, 2048
#: A partition of blocks takes so many bytes. Query blocks meet the partitions in so many tasks at least, each with so many vectors at most.
PART_BYTES, PAIR_TASKS, TASK_VECTORS = 1 << 22, 64, 4_000_000
#: Blocks that go to a Python worker at once; candidates that are scored at once; scores that are looked through at once.
ARROW_BLOCKS, CANDIDATES, SCORES = 2, 1 << 16, 1 << 20
#: A block of which queries read such a share is scored at once, not list by list.
DENSE = 0.25
#: Vectors that every query is compared with beforehand.
PROBE_ROWS = 8192


@dataclass(frozen=True)
class ListIndex:
    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray
    longest: float  # the norm that vectors are brought to
    ratio: float
    floor: float  # the usual distance of a query from its nearest centroid
    fewest: int  # so many nearest lists are read in any case
    probe: np.ndarray  # some of the sample's vectors, which tell every query a score it can count on
    probe_home: np.ndarray  # the list of each

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes them all as long as the longest."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", scaled, scaled), 0))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    def direction(self, queries: np.ndarray) -> np.ndarray:
        norms = np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        return np.concatenate([queries / norms, np.zeros((len(queries), 1))], axis=1)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1), 0)


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k-means where a full cluster costs more: its share above the mean is added to the distance."""
    draw = np.random.default_rng(seed)
    centroids = sample[draw.choice(len(sample), k, replace=False)].copy()
    price = np.zeros(k)
    for _ in range(rounds):
        home = np.empty(len(sample), np.int64)
        spread = 0.0
        for lo in range(0, len(sample), 4096):
            cost = _squared(sample[lo : lo + 4096], centroids)
            home[lo : lo + 4096] = (cost + price).argmin(axis=1)
            spread += cost.min(axis=1).sum()
        sizes = np.bincount(home, minlength=k)
        price = 0.5 * price + 0.1 * spread / len(sample) * (sizes * k / len(sample) - 1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        full = sizes > 0
        centroids[full] = sums[full] / sizes[full, None]
        centroids[~full] = sample[draw.choice(len(sample), int((~full).sum()))]
    return centroids


def _graph(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each centroid's nearest neighbours and, for connection, its successor in a ring; entry points."""
    k = len(centroids)
    degree = min(DEGREE, k - 1)
    near = np.empty((k, degree), np.int64)
    for lo in range(0, k, 2048):
        far = _squared(centroids[lo : lo + 2048], centroids)
        far[np.arange(len(far)), np.arange(lo, lo + len(far))] = np.inf
        near[lo : lo + 2048] = np.argsort(far, axis=1)[:, :degree]
    ring = (np.arange(k)[:, None] + 1) % k
    # a successor that is a near neighbour already is replaced by the centroid itself, which is known
    ring = np.where((near == ring).any(axis=1, keepdims=True), np.arange(k)[:, None], ring)
    return np.concatenate([near, ring], axis=1), np.unique(np.linspace(0, k - 1, 8).astype(np.int64))


def search_graph(index: ListIndex, points: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point the centroids that a beam search finds, nearest first, and their distances.

    All points walk at once: in each step everyone opens the nearest unopened centroid of the beam. A beam that was
    widened until it takes as many distances as there are centroids isn't walked: one product gives all of them."""
    n, k = len(points), len(index.centroids)
    breadth = min(breadth, k)
    if breadth == k or breadth > BREADTH and breadth * index.neighbours.shape[1] >= k:
        dist = np.sqrt(_squared(points, index.centroids))
        near = np.argpartition(dist, breadth - 1, axis=1)[:, :breadth] if breadth < k else np.repeat(np.arange(k)[None], n, axis=0)
        order = np.argsort(np.take_along_axis(dist, near, axis=1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        return near, np.take_along_axis(dist, near, axis=1)
    known = np.zeros((n, k), bool)
    opened = np.zeros((n, k), bool)
    squares = (index.centroids**2).sum(axis=1)
    far = lambda rows, nodes: np.sqrt(np.maximum((points[rows] ** 2).sum(axis=1)[:, None] - 2 * np.einsum("ijk,ik->ij", index.centroids[nodes], points[rows]) + squares[nodes], 0))
    everyone = np.arange(n)
    beam = np.repeat(index.entries[None, :breadth], n, axis=0)
    dist = far(everyone, beam)
    known[everyone[:, None], beam] = True
    walking = everyone
    while len(walking):
        shut = np.where(opened[walking[:, None], beam[walking]], np.inf, dist[walking])
        at = shut.argmin(axis=1)
        going = np.isfinite(shut[np.arange(len(walking)), at])
        walking, at = walking[going], at[going]
        if not len(walking):
            break
        node = beam[walking, at]
        opened[walking, node] = True
        nodes = index.neighbours[node]
        new = np.where(known[walking[:, None], nodes], np.inf, far(walking, nodes))
        known[walking[:, None], nodes] = True
        both, dists = np.concatenate([beam[walking], nodes], axis=1), np.concatenate([dist[walking], new], axis=1)
        order = np.argsort(dists, axis=1, kind="stable")[:, :breadth]
        if beam.shape[1] < order.shape[1]:
            room = order.shape[1] - beam.shape[1]
            beam = np.pad(beam, ((0, 0), (0, room)))
            dist = np.pad(dist, ((0, 0), (0, room)), constant_values=np.inf)
        beam[walking] = np.take_along_axis(both, order, axis=1)
        dist[walking] = np.take_along_axis(dists, order, axis=1)
        # a place of the beam that holds nothing counts as opened
        empty = ~np.isfinite(dist[walking])
        beam[walking] = np.where(empty, beam[walking][:, :1], beam[walking])
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(beam, order, axis=1), np.take_along_axis(dist, order, axis=1)


def home_lists(index: ListIndex, points: np.ndarray) -> list[list[int]]:
    """Lists of each point: the nearest, and near ones that no chosen list is nearer to than the point."""
    nodes, dist = search_graph(index, points, BREADTH)
    chosen = np.zeros((len(points), REPLICAS), np.int64)
    chosen[:, 0] = nodes[:, 0]
    count = np.ones(len(points), np.int64)
    for r in range(1, nodes.shape[1]):
        left = np.flatnonzero((dist[:, r] <= BOUNDARY * dist[:, 0]) & (count < REPLICAS))
        if not len(left):
            break
        here = index.centroids[nodes[left, r]]
        apart = np.full(len(left), np.inf)
        for place in range(count[left].max()):
            has = np.flatnonzero(count[left] > place)
            apart[has] = np.minimum(apart[has], np.linalg.norm(index.centroids[chosen[left[has], place]] - here[has], axis=1))
        new = left[apart > dist[left, r]]
        chosen[new, count[new]] = nodes[new, r]
        count[new] += 1
    return [row[:n].tolist() for row, n in zip(chosen, count.tolist(), strict=True)]


def query_lists(index: ListIndex, points: np.ndarray, sizes: np.ndarray, enough: int) -> list[np.ndarray]:
    """Lists within the ratio, and as many as hold `enough` entries; the beam is widened until its last
    centroid is beyond."""
    k, breadth = len(index.centroids), max(BREADTH, index.fewest + 1)
    out: list[np.ndarray | None] = [None] * len(points)
    left = np.arange(len(points))
    while len(left):
        nodes, dist = search_graph(index, points[left], breadth)
        held = np.cumsum(sizes[nodes], axis=1)
        inside = (dist <= index.ratio * np.maximum(dist[:, :1], index.floor) + 1e-12) | (held - sizes[nodes] < enough) | (np.arange(nodes.shape[1]) < index.fewest)
        done = ~inside[:, -1] | (breadth >= k)
        for i in np.flatnonzero(done):
            out[left[i]] = nodes[i][inside[i]]
        left, breadth = left[~done], breadth * 2
    return out


def fit_index(sample: np.ndarray, rows: int, longest: float, neighbours: int) -> ListIndex:
    """Centroids for `rows` vectors, and the ratio that reaches the sample's own nearest neighbours."""
    k = max(1, min(rows // LIST_ROWS, len(sample) // SAMPLE_PER_CENTROID))
    index = ListIndex(np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 1), np.int64), np.zeros(1, np.int64), longest, np.inf, 0.0, 1, sample[:PROBE_ROWS], np.zeros(len(sample[:PROBE_ROWS]), np.int64))
    points = index.place(sample)
    if k == 1:
        return index
    centroids = balanced_centroids(points, k)
    near, entries = _graph(centroids)
    index = ListIndex(centroids, near, entries, longest, np.inf, 0.0, 1, sample[:PROBE_ROWS], np.zeros(len(sample[:PROBE_ROWS]), np.int64))
    probe = sample[:PROBE_ROWS]
    probe_home = np.array([h[0] for lo in range(0, len(probe), 1024) for h in home_lists(index, index.place(probe[lo : lo + 1024]))], np.int64)
    asked = index.direction(sample[: min(400, len(sample))])
    scores = sample[: len(asked)] @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    best = np.argsort(-scores, axis=1)[:, : min(neighbours, len(sample) - 1)]
    far = np.sqrt(_squared(asked, centroids))
    homes = dict(zip(needed := np.unique(best).tolist(), home_lists(index, points[needed]), strict=True))
    floor = float(np.median(far.min(axis=1)))
    need = [far[i, homes[j]].min() / max(far[i].min(), floor, 1e-300) for i in range(len(asked)) for j in best[i].tolist()]
    rank = np.argsort(np.argsort(far, axis=1), axis=1)
    fewest = 1 + int(np.quantile([rank[i, homes[j]].min() for i in range(len(asked)) for j in best[i].tolist()], REACH_BY_RANK))
    return ListIndex(centroids, near, entries, longest, float(max(1.0, np.quantile(need, REACH))), floor, fewest, probe, probe_home)


def sure_scores(index: ListIndex, queries: np.ndarray, lists: list[list[int]], keep: int) -> np.ndarray:
    """A score that `keep` vectors in the lists of each query reach: no lesser one can be among its best."""
    if len(index.probe) < keep:
        return np.full(len(queries), -np.inf)
    read = np.zeros((len(queries), len(index.centroids)), bool)
    for k, own in enumerate(lists):
        read[k, own] = True
    scores = np.where(read[:, index.probe_home], queries @ index.probe.T, -np.inf)
    return np.partition(scores, len(index.probe) - keep, axis=1)[:, len(index.probe) - keep]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of vectors, in the type of their components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    rows = np.ascontiguousarray(rows)
    width = rows[:1].nbytes
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _one_row(**columns) -> pa.RecordBatch:
    """Arrays as bytes, lists as they are."""
    found = {k: pa.array([x.tobytes()], pa.binary()) if isinstance(x, np.ndarray) else pa.array([x], pa.list_(pa.int32())) for k, x in columns.items()}
    return pa.RecordBatch.from_pydict(found)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of the batches in tables of `rows` each, the last of less."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held)
            yield table.slice(0, rows).combine_chunks()
            held = table.slice(rows).combine_chunks().to_batches()
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


@contextmanager
def _arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, so many rows go to a Python worker at once."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


#: A vector's identity: its least id, and its hash, as an id can come with several vectors.
KEY = np.dtype([("rep", np.int64), ("h", np.int64)])


class AskedBlock:
    """Queries of a block and the best `keep` vectors of each so far; vectors come as blocks, sorted by list."""

    def __init__(self, queries: np.ndarray, least: np.ndarray, read: np.ndarray, longest: float, keep: int):
        self.queries, self.least, self.longest, self.keep = queries.astype(np.float64), least.copy(), longest, keep
        self.read = np.ascontiguousarray(read.T)  # by list
        self.norms = np.maximum(np.linalg.norm(self.queries, axis=1), 1e-300)
        self.units = (self.queries / self.norms[:, None]).astype(np.float32)
        # what a product of single precision can be off by, twice
        self.slack = (queries.shape[1] + 8) * 2.0**-22
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def meet(self, keys: np.ndarray, vectors: np.ndarray, lists: np.ndarray, counts: np.ndarray) -> None:
        units = (vectors / self.longest).astype(np.float32)
        wanted = self.read[lists]
        ends = np.cumsum(counts)
        if (wanted.sum(axis=1) * counts).sum() >= DENSE * len(self.queries) * len(vectors):
            list_of = np.repeat(np.arange(len(lists)), counts)
            self._look(np.arange(len(self.queries)), 0, units, keys, vectors, lambda i, j: wanted[list_of[j], i])
        else:
            for own, lo, hi in zip(wanted, ends - counts, ends, strict=True):
                if own.any():
                    self._look(np.flatnonzero(own), lo, units[lo:hi], keys, vectors, None)

    def _look(self, asking: np.ndarray, first: int, units: np.ndarray, keys: np.ndarray, vectors: np.ndarray, reads) -> None:
        step = max(1, SCORES // len(units))
        # a vector is in REPLICAS lists at most, so that many scores are of enough vectors
        enough = self.keep * REPLICAS
        for at in range(0, len(asking), step):
            own = asking[at : at + step]
            rough = self.units[own] @ units.T
            bound = (self.least[own] / self.norms[own] / self.longest - self.slack).astype(np.float32)
            # few reach it; of one dimension they are found much faster
            i, j = np.divmod(np.flatnonzero(rough >= bound[:, None]), len(units))
            if reads:
                kept = reads(own[i], j)
                i, j = i[kept], j[kept]
            if len(i) > 2 * enough * len(own):
                only = np.full(rough.shape, -np.inf, np.float32)
                only[i, j] = rough[i, j]
                bound = np.partition(only, len(units) - enough, axis=1)[:, len(units) - enough] - np.float32(self.slack)
                kept = rough[i, j] >= bound[i]
                i, j = i[kept], j[kept]
            for lo in range(0, len(i), CANDIDATES):
                query, row = own[i[lo : lo + CANDIDATES]], first + j[lo : lo + CANDIDATES]
                value = np.einsum("ij,ij->i", self.queries[query], vectors[row].astype(np.float64))
                least = self.least[query]
                kept = value >= least - 1e-9 * np.abs(np.nan_to_num(least, neginf=0.0)) - 1e-12
                self.found.append((query[kept], keys[row[kept]], value[kept]))
                self.waiting += int(kept.sum())
                if self.waiting >= CANDIDATES:
                    self.cut()

    def cut(self) -> None:
        """Only the best stay, and what others have to reach is known better."""
        if not self.found:
            return
        query, key, value = (np.concatenate(x) for x in zip(*self.found, strict=True))
        # a vector at a boundary comes from several lists, with the same score
        order = np.lexsort((value, key["h"], key["rep"], query))
        query, key, value = query[order], key[order], value[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (key[1:] != key[:-1])
        query, key, value = query[new], key[new], value[new]
        order = np.lexsort((key["h"], key["rep"], -value, query))
        query, key, value = query[order], key[order], value[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == self.keep - 1
        self.least[query[last]] = np.maximum(self.least[query[last]], value[last])
        best = place < self.keep
        self.found, self.waiting = [(query[best], key[best], value[best])], 0


def nearest(vectors: DataFrame, asked: F.Column, neighbours: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `vectors` (vec_id, embedding) where `asked` holds,
    the vectors of largest inner product that are found, but for rows of its own vec_id.

    Ties go to the lesser vec_id. Vectors that are NULL, empty or zero, that hold NULL or a non-finite
    component, or that have another length than most, take no part, nor do NULL ids; repeated rows count
    once; other columns are ignored; an empty table gives no rows. Equal vectors are searched as one:
    of them only the least neighbours + 1 ids can be among anyone's nearest, so no answer is lost."""
    spark = vectors.sparkSession
    single = vectors.select("embedding").schema[0].dataType.elementType == T.FloatType()
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), asked.alias("asked"), (F.col("embedding") if single else F.col("embedding").cast("array<double>")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.coalesce(~bad, F.lit(False)) & F.exists("v", lambda x: x != 0)).withColumn("h", F.xxhash64(F.col("v").cast("array<double>")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("longest")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, dtype = common["dim"], np.dtype(np.float32 if single else np.float64)
    rows = rows.where(F.size("v") == dim)
    # most vectors are there once: only those whose hash comes again are moved to be compared
    again = checkpoint(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    copied = again.agg(F.count("*").alias("hashes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    flagged = flag_keys(rows, "h", {"copied": again.select("h")}) if copied["hashes"] else rows.withColumn("copied", F.lit(False))
    by_vector = Window.partitionBy("h", "v").orderBy("vec_id")
    few = flagged.where("copied").select("h", "v", "vec_id").distinct().withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= neighbours + 1)
    copies = checkpoint(few.groupBy("h", "v").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    alone = flagged.where("NOT copied").withColumn("rep", F.col("vec_id"))
    equal = alone.select("rep", "h", "v").unionByName(copies.select("rep", "h", "v"))
    total = common["n"] - copied["rows"] + copied["hashes"]
    sample = cut_by_hash(equal.select("h", "v"), F.col("h"), SAMPLE_ROWS, total).select("v").toArrow()["v"]
    index = fit_index(_matrix(sample).astype(np.float64), total, common["longest"], neighbours)
    shared = spark.sparkContext.broadcast(index)
    keep = neighbours + 1

    # long lists are dealt out as pieces; how long they are is told by the probe
    share = np.bincount(index.probe_home, minlength=len(index.centroids)) / max(1, len(index.probe_home))
    pieces = np.maximum(1, np.ceil(share * total / BLOCK_ROWS)).astype(np.uint64)
    block_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (dim * dtype.itemsize)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                own = _matrix(part.column("v"))
                homes = home_lists(shared.value, shared.value.place(own.astype(np.float64)))
                row = np.repeat(np.arange(len(own)), [len(x) for x in homes])
                to = np.concatenate(homes).astype(np.int32)
                h = part.column("h").to_numpy()[row]
                piece = (h.view(np.uint64) % pieces[to]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(piece), pa.array(part.column("rep").to_numpy()[row]), pa.array(h), _binary(own[row])], ["list", "piece", "rep", "h", "v"])

    def keys_of(table: pa.Table) -> np.ndarray:
        keys = np.empty(table.num_rows, KEY)
        keys["rep"], keys["h"] = table["rep"].to_numpy(), table["h"].to_numpy()
        return keys

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, block_rows):
            lists, counts = np.unique(table["list"].to_numpy(), return_counts=True)
            own = np.frombuffer(b"".join(table["v"].to_pylist()), np.uint8)
            yield _one_row(lists=lists.tolist(), counts=counts.tolist(), keys=keys_of(table), vectors=own)

    parts = -(-total * dim * dtype.itemsize // PART_BYTES)
    posted = equal.mapInArrow(post, "list int, piece int, rep long, h long, v binary").repartition(max(1, parts), "list", "piece").sortWithinPartitions("list")
    blocks = checkpoint(posted.mapInArrow(pack, "lists array<int>, counts array<int>, keys binary, vectors binary"))
    counted = blocks.select(F.explode(F.arrays_zip("lists", "counts")).alias("x")).groupBy(F.col("x.lists").alias("list")).agg(F.sum("x.counts").alias("n")).toPandas()
    sizes = np.zeros(len(index.centroids), np.int64)
    sizes[counted["list"].to_numpy()] = counted["n"].to_numpy()
    # a vector is in REPLICAS lists at most, so that many entries hold enough vectors
    enough = REPLICAS * keep

    of_copies = flagged.where("asked AND copied").select("h", "v", F.col("vec_id").alias("query_id")).distinct().join(copies.select("h", "v", "rep"), ["h", "v"])
    queries = alone.where("asked").select(F.col("vec_id").alias("query_id"), "rep", "h", "v").unionByName(of_copies.select("query_id", "rep", "h", "v"))
    queries = checkpoint(queries)
    unique = queries.groupBy("rep", "h").agg(F.first("v").alias("v"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                nodes, _ = search_graph(shared.value, shared.value.direction(_matrix(part.column("v")).astype(np.float64)), BREADTH)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes[:, 0], pa.int32())], [*part.schema.names, "home"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, 2 * QUERY_ROWS):
            own = _matrix(table["v"])
            read, least = np.zeros((len(own), len(shared.value.centroids)), bool), np.empty(len(own))
            for lo in range(0, len(own), 1024):
                asking = own[lo : lo + 1024].astype(np.float64)
                lists = query_lists(shared.value, shared.value.direction(asking), sizes, enough)
                least[lo : lo + 1024] = sure_scores(shared.value, asking, lists, keep)
                for k, x in enumerate(lists, lo):
                    read[k, x] = True
            yield _one_row(reads=np.flatnonzero(read.any(axis=0)).tolist(), asking=keys_of(table), queries=own, least=least, bits=np.packbits(read, axis=1))

    # queries near each other make a block, so that it reads few lists where vectors have structure
    tasks = max(1, -(-unique.count() // QUERY_ROWS))
    homed = unique.mapInArrow(near, f"rep long, h long, v array<{'float' if single else 'double'}>, home int")
    asking = checkpoint(homed.repartitionByRange(tasks, "home", "h", "rep").mapInArrow(ask, "reads array<int>, asking binary, queries binary, least binary, bits binary"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[np.ndarray, AskedBlock]] = {}
        for batch in batches:
            bytes_of = lambda name, k, batch=batch: batch.column(name)[k].as_buffer()
            for k in range(batch.num_rows):
                name = bytes(bytes_of("asking", k)[: KEY.itemsize])
                if name not in held:
                    own = np.frombuffer(bytes_of("asking", k).to_pybytes(), KEY)
                    bits = np.frombuffer(bytes_of("bits", k), np.uint8).reshape(len(own), -1)
                    read = np.unpackbits(bits, axis=1, count=len(shared.value.centroids)).astype(bool)
                    held[name] = own, AskedBlock(np.frombuffer(bytes_of("queries", k), dtype).reshape(len(own), -1), np.frombuffer(bytes_of("least", k), np.float64), read, shared.value.longest, keep)
                keys = np.frombuffer(bytes_of("keys", k), KEY)
                held[name][1].meet(keys, np.frombuffer(bytes_of("vectors", k), dtype).reshape(len(keys), -1), batch.column("lists")[k].values.to_numpy(), batch.column("counts")[k].values.to_numpy())
        for own, block in held.values():
            block.cut()
            for query, key, value in block.found:
                yield pa.RecordBatch.from_pydict({"query": own["rep"][query], "query_h": own["h"][query], "rep": key["rep"], "h": key["h"], "score": value})

    # every block of queries meets every block of vectors of which it reads a list; the stored blocks are read again for that
    spread = min(max(1, parts), max(-(-PAIR_TASKS // tasks), -(-total // TASK_VECTORS)))
    met = blocks.coalesce(spread).join(asking.hint("shuffle_replicate_nl"), F.arrays_overlap("reads", "lists"))
    found = met.mapInArrow(score, "query long, query_h long, rep long, h long, score double")
    query = ["query", "query_h"]
    same = Window.partitionBy(*query, "rep", "h").orderBy("score")
    best = Window.partitionBy(*query).orderBy(F.desc("score"), "rep", "h")
    found = found.repartition(*query).withColumn("place", F.row_number().over(same)).where("place = 1")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep).select(*query, "rep", "h", "score")
    with _arrow_rows(spark, ARROW_BLOCKS):
        found = checkpoint(found)
    order = Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id")
    found = found.join(copies.select("rep", "h", "ids"), ["rep", "h"], "left").select(*query, "score", F.explode(F.coalesce("ids", F.array("rep"))).alias("vec_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    answers = found.groupBy(F.col("query").alias("rep"), F.col("query_h").alias("h")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    result = queries.select("query_id", "rep", "h").join(answers, ["rep", "h"])
    own_out = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, neighbours)
    result = result.select("query_id", F.posexplode(own_out).alias("place", "hit"))
    return result.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
