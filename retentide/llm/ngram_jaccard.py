"""Exact Jaccard join of documents on their word shingles, with relations between sets.

A document's set holds its distinct shingles, as 64-bit hashes. Documents with the same set are one
node, named by a hash of the set, so exact copies cost nothing after the first look. Nodes meet in
lists of the shingles in their prefixes (rarest shingles first): two sets as similar as asked share
at least one. Two relations keep the lists from being worked off pair by pair:

* Index level. A list is ordered by set size and cut into blocks. A block meets only blocks whose
  sizes can reach the similarity, blocks of one component meet nobody, and positions of the shared
  shingle bound the overlap of two entries.
* Answer level. Each list offers its members a leader. A member that is verified as similar to its
  leader takes the leader's component as its answer. What is left are pairs across components, and
  for them the overlap of the two leaders, computed once, bounds the overlap of all their members
  from both sides; only pairs that the bounds leave open are compared themselves.

Every link between different sets is found, up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retentide.llm.arrow_text import PLACES, TOKENS, mix, slices, text_groups, windows, words
from retentide.llm.components import connected_components
from retentide.llm.spark_util import bitmap_of, checkpoint, in_bitmap

#: Frequent shingles whose counts decide the order; the order changes the work, never the result.
FREQUENT = 1 << 19
#: A task looks for shingles that come up this often among so many shingles.
LOCALLY_FREQUENT, LOCAL_WINDOW = 4, 1 << 21
BLOCK_ROWS = 2048
#: Leaders of a long list, and how many members it takes for one more; the leaders tried in each round.
LEADERS, LEADERS_EVERY = 64, 4
LEADER_ROUNDS = ((1, 3), (4, 12), (13, 64))
#: Places of a set's sketch for each of its shingles, at least.
SKETCH_BITS = 2
#: Shingles whose sets are sketched at once, beyond a single set.
SKETCHED_AT_ONCE = 1 << 16
#: Longs of the sketch that a posting carries into the join, and the largest sets that they tell apart.
JOINED_LONGS, JOINED_SETS = 8, 768
#: Of the shingles that two prefixes must share, one in so many is looked for.
SHARE_JOINED = 4


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The set of each text, sorted, one after the other, and their offsets."""
    n = len(at) - 1
    w = words(data, at, TOKENS)
    bounds = w.per_text(n)
    lengths = np.diff(bounds)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    values = np.empty(offsets[-1], np.uint64)
    full = windows(w.hashes, size)
    for k in range(n):
        lo, m = bounds[k], lengths[k]
        if m >= size:
            values[offsets[k] : offsets[k + 1]] = full[lo : lo + m - size + 1]
            values[offsets[k] : offsets[k + 1]].sort()
        elif m:
            values[offsets[k]] = mix((w.hashes[lo : lo + m] * PLACES[:m]).sum(keepdims=True) + np.uint64(m))[0]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[offsets[:-1][counts > 0]] = True
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return values[new], kept[offsets]


def set_names(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty one."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ PLACES[40]), out=total[1:])
    sizes = np.diff(bounds)
    names = mix(total[bounds[1:]] - total[bounds[:-1]] + sizes.astype(np.uint64) * PLACES[41])
    return np.where(sizes > 0, np.maximum(names, np.uint64(1)), np.uint64(0))


def parity_sketches(values: np.ndarray, bounds: np.ndarray, least: int = 64) -> list[bytes]:
    """For each set, the parity of its shingles in each of as many places as SKETCH_BITS times its size, rounded up
    to a power of two, or in `least` if that is more: a shingle that only one of two sets has flips one place, so two sketches never differ in more
    places than the sets do in shingles."""
    sizes = np.diff(bounds)
    bits = np.where(sizes > 0, np.maximum(least, 1 << np.ceil(np.log2(np.maximum(sizes * SKETCH_BITS, 1))).astype(np.int64)), 0)
    out: list[bytes] = []
    for first, last in text_groups(bounds, SKETCHED_AT_ONCE):
        some = bits[first:last]
        starts = np.concatenate([[0], np.cumsum(some)])
        owner = np.repeat(np.arange(last - first), sizes[first:last])
        place = values[bounds[first] : bounds[last]] & (some[owner] - 1).astype(np.uint64)
        flips = np.bincount(starts[owner] + place.astype(np.int64), minlength=starts[-1]) & 1
        packed = np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
        out += [packed[a // 8 : b // 8] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    return out


def sketch_distance(a: bytes, b: bytes) -> int:
    """The places in which two sketches differ, the longer one folded to the shorter: at most |A xor B|."""
    x, y = sorted((np.frombuffer(s, np.uint64) for s in (a, b)), key=len)
    if not len(x):
        return 0
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sets_in(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for first, last, data, at in slices(batch.column("text")):
        values, bounds = shingle_sets(data, at, size)
        yield first, last, values, bounds, set_names(values, bounds)


def row_key() -> F.Column:
    """A key of the rows of documents, also of those whose doc_id is NULL or comes with several texts."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def describe_sets(docs: DataFrame, size: int) -> DataFrame:
    """A row (doc_id, key, n, node, sketch) for each document, and rows (shingle, n) for shingles that a task has seen often.
    A task writes the sketch of a set once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        room, drawn = LOCAL_WINDOW, set()
        columns = ["doc_id", "key", "n", "node", "shingle", "sketch"]

        def frequent() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(pending), return_counts=True)
            found, counts = found[counts >= LOCALLY_FREQUENT], counts[counts >= LOCALLY_FREQUENT]
            none = pa.nulls(len(found), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.array(counts, pa.int64()), none, pa.array(_signed(found)), pa.nulls(len(found), pa.binary())], columns)

        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key")
            for first, last, values, bounds, names in _sets_in(batch, size):
                n = last - first
                sketches: list[bytes | None] = parity_sketches(values, bounds, 64 * JOINED_LONGS)
                for k, name in enumerate(names.tolist()):
                    if name in drawn or not name:
                        sketches[k] = None
                    drawn.add(name)
                yield pa.RecordBatch.from_arrays([ids.slice(first, n), keys.slice(first, n), pa.array(np.diff(bounds), pa.int64()), pa.array(_signed(names)), pa.nulls(n, pa.int64()), pa.array(sketches, pa.binary())], columns)
                pending.append(values)
                room -= len(values)
                if room <= 0:
                    yield frequent()
                    pending, room = [], LOCAL_WINDOW
        if pending:
            yield frequent()

    return docs.select("doc_id", "text", row_key().alias("key")).mapInArrow(scan, "doc_id long, key long, n long, node long, shingle long, sketch binary")


def _ordered(values: np.ndarray, bounds: np.ndarray, known: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the shingles, each set by (weight, shingle): shingles that aren't known weigh nothing."""
    place = np.searchsorted(known, values)
    place[place == len(known)] = 0
    heavy = np.where(known[place] == values, weight[place], 0) if len(known) else np.zeros(len(values), np.int64)
    order = np.arange(len(values))
    touched = np.add.reduceat(np.append(heavy, 0), np.minimum(bounds[:-1], len(values))) > 0 if len(bounds) > 1 else []
    for k in np.flatnonzero(touched):
        lo, hi = bounds[k], bounds[k + 1]
        order[lo:hi] = lo + np.argsort(heavy[lo:hi], kind="stable")
    return order


def postings(docs: DataFrame, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A row (shingle, n, node, pos) for each shingle in the prefix of each set; a task writes a set once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, values, bounds, names in _sets_in(batch, size):
                order = _ordered(values, bounds, known, weight)
                sizes = np.diff(bounds)
                prefix = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
                for k, name in enumerate(names.tolist()):
                    if name in seen:
                        prefix[k] = 0
                    seen.add(name)
                total = int(prefix.sum())
                starts = np.cumsum(prefix) - prefix
                pos = np.arange(total) - np.repeat(starts, prefix)
                at = order[np.repeat(bounds[:-1], prefix) + pos]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(values[at])), pa.array(np.repeat(sizes, prefix).astype(np.int32)), pa.array(np.repeat(_signed(names), prefix)), pa.array(pos.astype(np.int32))],
                    ["shingle", "n", "node", "pos"],
                )

    return docs.select("text").mapInArrow(scan, "shingle long, n int, node long, pos int")


def shared_postings(found: DataFrame, percent: int) -> DataFrame:
    """Postings of shingles that several nodes have, with the block of the list they are in and two leaders.

    A list is ordered by classes of sizes that can be similar, then by name, which is a random order that
    all lists share. The first nodes of a class lead it: one of them where it is short, up to LEADERS where
    it is long, dealt out by shingle (two a list), so that the members of a large group are offered several leaders."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first row of a list, until a second one comes
        shingle, last, count, rank, kind = None, None, 0, 0, None
        leaders: list[int] = []
        for batch in batches:
            s, n, v, p, c = (batch.column(k).to_numpy() for k in range(5))
            repeated = np.zeros(len(s), bool)
            repeated[1:] = (s[1:] == s[:-1]) & (v[1:] == v[:-1])
            if len(s):
                repeated[0] = s[0] == shingle and v[0] == last
            s, n, v, p, c = (x[~repeated] for x in (s, n, v, p, c))
            if not len(s):
                continue
            new = np.ones(len(s), bool)
            new[1:] = s[1:] != s[:-1]
            new[0] = s[0] != shingle
            heads = np.flatnonzero(new)
            ends = np.append(heads[1:], len(s))
            last = v[-1]
            out: list[tuple] = []

            def rows(lo: int, hi: int) -> None:
                nonlocal count, rank, kind, leaders
                for i in range(lo, hi):
                    if not count or c[i] != kind:
                        kind, rank, leaders = c[i], 0, []
                    if rank < LEADERS:
                        leaders.append(v[i])
                    turns = min(LEADERS, 1 + rank // LEADERS_EVERY)
                    pick = int(s[i])
                    out.append((s[i], n[i], v[i], p[i], count // BLOCK_ROWS, leaders[(pick & 0xFFFF) % turns], leaders[(pick >> 16 & 0xFFFF) % turns], turns))
                    count += 1
                    rank += 1

            first = heads[0] if len(heads) else len(s)
            if first:  # the list of the batch before goes on
                if held:
                    out.append(held)
                    held = None
                rows(0, first)
            elif len(heads):
                held = None
            several = ends - heads > 1
            for lo, hi in zip(heads[several], ends[several], strict=True):
                count = 0
                rows(lo, hi)
            if len(heads):
                lo = heads[-1]
                shingle = s[lo]
                if not several[-1]:
                    count = 0
                    rows(lo, lo + 1)
                    held = out.pop()
            if out:
                columns = list(zip(*out, strict=True))
                types = (np.int64, np.int32, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, t)) for x, t in zip(columns, types, strict=True)], ["shingle", "n", "node", "pos", "block", "leader", "second", "turns"])

    ordered = found.withColumn("class", F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")).repartition("shingle").sortWithinPartitions("shingle", "class", "node")
    return ordered.mapInArrow(scan, "shingle long, n int, node long, pos int, block int, leader long, second long, turns int")


def _texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of the documents in `keys`; a bitmap of them keeps the other texts from being shuffled."""
    wanted = bitmap_of(keys, "key")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = in_bitmap(wanted.value, batch.column("key").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(chosen))

    of = lambda rows: rows.select(row_key().alias("key"), "text").mapInArrow(scan, "key long, text string")
    # without an id, all rows of a text have one key
    return of(docs.where("doc_id IS NOT NULL")).union(of(docs.where("doc_id IS NULL")).distinct())


def possible(pairs: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches don't rule out the similarity: 100 * shared >= percent * union means that
    the sets differ in at most (100 - percent) / (100 + percent) of n_a + n_b shingles. No text is moved for the others."""
    for side in "ab":
        pairs = pairs.join(documents.select(F.col("node").alias(side), F.col("n").alias("n_" + side), F.col("sketch").alias("sketch_" + side)), side)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = (100 - percent) * sizes // (100 + percent)
            near = [sketch_distance(a, b) <= m for a, b, m in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), most.tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(scan, "a long, b long")


def overlaps(docs: DataFrame, pairs: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """pairs (a, b) of nodes with their sizes and overlap: (a, b, n_a, n_b, shared).

    Texts are shuffled, not sets: they compress better. A text that has the key of a node's document but
    another set, as equal hashes can, is told by the set's name."""
    for side in "ab":
        pairs = pairs.join(documents.select(F.col("node").alias(side), F.col("key").alias("key_" + side)), side)
    pairs = checkpoint(pairs)
    texts = _texts_of(docs, pairs.select(F.explode(F.array("key_a", "key_b")).alias("key")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 128):
                batch = whole.slice(lo, 128)
                sides = []
                for side in "ab":
                    column, wanted, found = batch.column("text_" + side), batch.column(side).to_numpy().view(np.uint64), []
                    for first, last, data, at in slices(column):
                        values, bounds = shingle_sets(data, at, size)
                        named = set_names(values, bounds) == wanted[first:last]
                        found += [values[bounds[k] : bounds[k + 1]] if named[k] else None for k in range(last - first)]
                    sides.append(found)
                rows = [k for k, (x, y) in enumerate(zip(*sides, strict=True)) if x is not None and y is not None]
                out = np.zeros((3, len(rows)), np.int64)
                for i, k in enumerate(rows):
                    small, large = sorted((sides[0][k], sides[1][k]), key=len)
                    place = np.searchsorted(large, small)
                    place[place == len(large)] = 0
                    out[:, i] = len(sides[0][k]), len(sides[1][k]), (large[place] == small).sum()
                kept = batch.select(["a", "b"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, out)], ["a", "b", "n_a", "n_b", "shared"])

    # the side with a hot leader is joined first, while rows are small
    joined = pairs.join(texts.toDF("key_b", "text_b"), "key_b").join(texts.toDF("key_a", "text_a"), "key_a")
    return checkpoint(joined.select("a", "b", "text_a", "text_b").mapInArrow(scan, "a long, b long, n_a long, n_b long, shared long").distinct())


def _linked(percent: int, shared: str = "shared") -> F.Column:
    return F.expr(f"100 * {shared} >= {percent} * (n_a + n_b - {shared})")


def joined_sketches(documents: DataFrame) -> DataFrame:
    """(node, s0, s1, ...): sketches folded to JOINED_LONGS longs, NULL for sets that are too large to be told apart by them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = [np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, JOINED_LONGS), axis=0) for x in batch.column("sketch").to_pylist()]
            large = batch.column("n").to_numpy() > JOINED_SETS
            longs = np.array(folded, np.int64).reshape(-1, JOINED_LONGS)
            columns = [pa.array(longs[:, k], mask=large) for k in range(JOINED_LONGS)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], ["node", *(f"s{k}" for k in range(JOINED_LONGS))])

    return documents.select("node", "n", "sketch").mapInArrow(scan, "node long, " + ", ".join(f"s{k} long" for k in range(JOINED_LONGS)))


def cross_pairs(lists: DataFrame, component: DataFrame, percent: int, documents: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share a prefix shingle and whose sizes,
    positions and sketches leave room for the similarity. Blocks that can't have such a pair aren't joined."""
    rows = lists.join(component, "node", "left").select("shingle", "n", "node", "pos", "block", F.coalesce("component", "node").alias("component"))
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("shingle")
    rows = checkpoint(rows.join(mixed, "shingle").join(joined_sketches(documents), "node"))
    blocks = rows.groupBy("shingle", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    x, y = (blocks.select("shingle", *(F.col(c).alias(c + side) for c in ("block", "low", "high", "c1", "c2"))) for side in "xy")
    meet = x.join(y, "shingle").where(f"blockx <= blocky AND lowy * {percent} <= highx * 100 AND NOT (c1x = c2x AND c1y = c2y AND c1x = c1y)")
    carried = ("block", "n", "node", "pos", "component", *(f"s{k}" for k in range(JOINED_LONGS)))
    left, right = (rows.select("shingle", *(F.col(c).alias(c + side) for c in carried)) for side in "xy")
    need = f"ceil({percent} * (nx + ny) / {100 + percent})"
    # Shingles beyond a prefix are at most so many: the prefixes have to share the others. The first `first`
    # of those stand where enough places follow in both prefixes, so the entries after that aren't joined.
    shared = f"greatest(1, {need} - greatest(ceil({percent} * nx / 100), ceil({percent} * ny / 100)) + 1)"
    first = f"ceil({shared} / {SHARE_JOINED})"
    reach = lambda side: f"pos{side} < n{side} - ceil({percent} * n{side} / 100) + 1 - {shared} + {first}"
    # as in `possible`, before the pair is a row; NULL sketches rule nothing out
    apart = " + ".join(f"bit_count(s{k}x ^ s{k}y)" for k in range(JOINED_LONGS))
    near = f"coalesce({apart} <= {100 - percent} * (nx + ny) div {100 + percent}, true)"
    pairs = (
        meet.select("shingle", "blockx", "blocky")
        .join(left, ["shingle", "blockx"])
        .join(right, ["shingle", "blocky"])
        .where(f"componentx <> componenty AND (blockx < blocky OR nodex < nodey) AND nx * 100 >= ny * {percent} AND ny * 100 >= nx * {percent}")
        .where(f"least(posx, posy) + least(nx - posx, ny - posy) >= {need} AND {reach('x')} AND {reach('y')} AND {near}")
    )
    pairs = pairs.select(F.least("nodex", "nodey").alias("a"), F.greatest("nodex", "nodey").alias("b"), F.expr(first).alias("first"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("times"), F.max("first").alias("first")).where("times >= first").select("a", "b")


def similar_components(docs: DataFrame, size: int = 5, percent: int = 80, keyed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs` (doc_id, text, ...).

    Words are runs without ASCII white space, A-Z as a-z. A set holds the distinct windows of `size`
    words; fewer words are one window; no words (also NULL or empty text) are the empty set, which links
    with nothing. Two documents link when 100 * intersection >= percent * union. component_id is the
    least doc_id that links reach, the row's own included. Repeated rows each get a row and link with one
    another; a NULL doc_id takes part and never names a component, unless the component has no other.
    An empty table gives no rows; other columns are ignored. With `keyed`, rows also have their row_key as
    `key` and `component`, which tells apart components that a repeated id names alike."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    described = checkpoint(describe_sets(docs, size))
    members = described.where("shingle IS NULL").select("doc_id", "key", "n", "node")
    documents = described.where("shingle IS NULL AND n > 0").groupBy("node").agg(F.min("key").alias("key"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    counted = described.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    known = counted["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    frequent = (known[order], counted["n"].to_numpy(np.int64)[order])
    lists = checkpoint(shared_postings(postings(docs, size, percent, frequent), percent))

    links = spark.createDataFrame([], "a long, b long, n_a long, n_b long, shared long")
    component = spark.createDataFrame([], "node long, component long")
    each = lists.select("node", "turns", "n", F.explode(F.array_distinct(F.array("leader", "second"))).alias("leader"))
    # whom to try first: leaders of many lists, short lists counting more; this decides nothing
    offers = each.where("leader <> node").groupBy("node", "leader").agg(
        F.sum(1 / F.col("turns")).alias("weight"), F.sum("turns").alias("turns"), F.max("n").alias("n")
    )
    best = Window.partitionBy("node").orderBy(F.desc("weight"), "leader")
    offers = offers.withColumn("place", F.row_number().over(best)).where(F.col("place") <= LEADER_ROUNDS[-1][1])
    # beyond the first round, only those that share about a quarter of what prefixes of equal sets must share
    likely = F.expr(f"4 * turns >= n * {percent * (100 - percent)} / {100 * (100 + percent)}")
    offers = checkpoint(offers.where((F.col("place") <= LEADER_ROUNDS[0][1]) | likely).select("node", "leader", "place"))
    for low, high in LEADER_ROUNDS:
        # those that have no component yet, or are in another one than the leaders that are offered next
        a, b = component.toDF("a", "component_a"), component.toDF("b", "component_b")
        tried = offers.where(F.col("place").between(low, high)).select(F.col("node").alias("a"), F.col("leader").alias("b")).join(a, "a", "left").join(b, "b", "left")
        tried = checkpoint(possible(tried.where("coalesce(component_a, a) <> coalesce(component_b, b)").select("a", "b"), documents, percent))
        if tried.isEmpty():
            continue
        links = checkpoint(links.union(overlaps(docs, tried, documents, size).where(_linked(percent))))
        component = checkpoint(connected_components(links))

    # each node's answer so far: a leader that it is linked with, and how far the two sets differ
    first = Window.partitionBy("a").orderBy(F.desc("shared"), "b")
    lead = links.withColumn("place", F.row_number().over(first)).where("place = 1").select("a", "b", F.expr("n_a - shared").alias("own"), F.expr("n_b - shared").alias("lost"))
    lead = checkpoint(lead)
    pairs = checkpoint(possible(cross_pairs(lists, component, percent, documents), documents, percent))
    for side in "ab":
        of = lead.select(F.col("a").alias(side), F.col("b").alias("lead_" + side), F.col("own").alias("own_" + side), F.col("lost").alias("lost_" + side))
        pairs = pairs.join(of, side, "left").withColumn("lead_" + side, F.coalesce("lead_" + side, side)).fillna(0, ["own_" + side, "lost_" + side])
    sizes = members.where("n > 0").groupBy("node").agg(F.min("n").alias("n"))
    for side in "ab":
        pairs = pairs.join(sizes.select(F.col("node").alias(side), F.col("n").alias("n_" + side)), side)
    pairs = checkpoint(pairs)
    leads = pairs.select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b")).distinct()
    known_pairs = overlaps(docs, leads, documents, size).select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("shared").alias("between"))
    judged = pairs.withColumns({"x": F.least("lead_a", "lead_b"), "y": F.greatest("lead_a", "lead_b")}).join(known_pairs, ["x", "y"])
    judged = checkpoint(
        judged.withColumn("most", F.least(F.expr("between + own_a + own_b"), "n_a", "n_b")).withColumn("least", F.expr("greatest(0, between - lost_a - lost_b)")).where(_linked(percent, "most"))
    )
    sure = judged.where(_linked(percent, "least")).select("a", "b")
    open_pairs = judged.where(~_linked(percent, "least")).select("a", "b")
    late = overlaps(docs, open_pairs, documents, size).where(_linked(percent)).select("a", "b")
    component = connected_components(links.select("a", "b").union(sure).union(late))

    rows = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = rows.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("name"))
    return rows.join(name, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"), *(["key", "component"] if keyed else [])
    )
