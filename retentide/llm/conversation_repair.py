"""Faults of conversations, and their cheapest repair, by a dynamic program that keeps the whole audit.

The program goes through a conversation's rows with four states: nothing kept, a system turn, a user turn
that waits for its answer, an answer. A state's audit (the initials of its edits) is a linked node that
shares its prefix with the others'. A node knows its ancestors 1, 2, 4 ... edits back and a rolling hash
of its audit, so two audits of equal cost are compared by a search for their longest common prefix; what
the hashes call equal is verified edit by edit as far as the two don't share nodes.

Rows are sorted by conversation and turn over all tasks, without their texts, so a long conversation lies
in several of them. Each task reduces its stretch, in segments of bounded length, to the cheapest audit
from each state to each other; segments are then put together in order. The hash of the repaired text has
to be taken in order, so the texts of a conversation stream through one task, which holds none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one run of the program covers.
SEGMENT_ROWS = 4096
MODULUS, BASE = (1 << 61) - 1, 1_000_003
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: States: nothing kept, system, user, assistant; (state, role initial) -> state.
START, SYSTEM, USER, ANSWER = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWER, (ANSWER, "u"): USER}
FINAL = (START, ANSWER)
EVERY = (START, SYSTEM, USER, ANSWER)
#: White space, and the ends of sentences.
BLANK, ENDS = " \t\n\x0b\f\r", ".!?"
#: Neighbouring role initials that are in order.
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}


@dataclass(slots=True, eq=False)
class Node:
    """An audit: its last edit, and its ancestors that are 1, 2, 4 ... edits shorter."""

    edit: str
    depth: int
    hash: int
    up: tuple[Node, ...]

    def then(self, edit: str, modulus: int = MODULUS) -> Node:
        up, k = [self], 0
        while k < len(up[-1].up):
            up.append(up[-1].up[k])
            k += 1
        return Node(edit, self.depth + 1, (self.hash * BASE + ord(edit)) % modulus, tuple(up))

    def back(self, edits: int) -> Node:
        node, k = self, 0
        while edits:
            if edits & 1:
                node = node.up[k]
            edits, k = edits >> 1, k + 1
        return node

    def text(self) -> str:
        out, node = [], self
        while node.up:
            out.append(node.edit)
            node = node.up[0]
        return "".join(reversed(out))


def root() -> Node:
    return Node("", 0, 0, ())


def precedes(x: Node, y: Node) -> bool:
    """Whether x's audit comes before y's in the order of strings."""
    depth = min(x.depth, y.depth)
    a, b = x.back(x.depth - depth), y.back(y.depth - depth)
    differ = a.hash != b.hash
    if differ:  # the shortest prefixes whose hashes differ
        for k in reversed(range(len(a.up))):
            if k < len(a.up) and k < len(b.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        verdict: bool | None = a.edit < b.edit
        a, b = a.up[0], b.up[0]
    else:
        verdict = None
    # equal hashes can lie: the earliest edit that differs decides
    while a is not b and a.up:
        if a.edit != b.edit:
            verdict = a.edit < b.edit
        a, b = a.up[0], b.up[0]
    return x.depth < y.depth if verdict is None else verdict


@dataclass
class Frontier:
    """The cheapest audit that ends in each state."""

    modulus: int = MODULUS
    best: dict[int, tuple[int, Node]] = field(default_factory=dict)

    def offer(self, found: dict[int, tuple[int, Node]], state: int, cost: int, before: Node, edit: str) -> bool:
        old = found.get(state)
        if old and old[0] < cost:
            return False
        node = before.then(edit, self.modulus)
        if old and old[0] == cost and not precedes(node, old[1]):
            return False
        found[state] = cost, node
        return True

    def insert(self) -> None:
        """Lets a state be reached by inserted turns; more than one for each state never pay."""
        for _ in range(2):
            for state, (cost, node) in list(self.best.items()):
                role = "a" if state == USER else "u"
                self.offer(self.best, STEPS[state, role], cost + INSERT, node, "I")

    @classmethod
    def at(cls, state: int, modulus: int = MODULUS) -> Frontier:
        out = cls(modulus, {state: (0, root())})
        out.insert()
        return out

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.best.items():
            self.offer(found, state, cost + DELETE, node, "D")
            if must_go:
                continue
            extra = TRUNCATED * truncated
            if (state, initial) in STEPS:
                self.offer(found, STEPS[state, initial], cost + extra, node, "K")
            role = "a" if state == USER else "u"
            if role != initial:
                self.offer(found, STEPS[state, role], cost + REROLE + extra, node, "R")
        self.best = found
        self.insert()


def repair(rows: Iterable[tuple[str, bool, bool]], modulus: int = MODULUS) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows (role initial, blank or duplicate, truncated)."""
    frontier = Frontier.at(START, modulus)
    for row in rows:
        frontier.row(*row)
    return min((cost, node.text()) for state, (cost, node) in frontier.best.items() if state in FINAL)


@dataclass
class Chain:
    """Segments put together in order: for each state the cost and a chain of the segments' audits."""

    best: dict[int, tuple[int, tuple | None]] = field(default_factory=lambda: {START: (0, None)})

    def add(self, paths: list[dict]) -> None:
        found: dict[int, tuple[int, tuple | None]] = {}
        for p in paths:
            if p["first"] not in self.best:
                continue
            cost, before = self.best[p["first"]]
            new = cost + p["cost"], (before, p["audit"])
            old = found.get(p["last"])
            if old is None or new[0] < old[0] or new[0] == old[0] and self._precedes(new[1], old[1]):
                found[p["last"]] = new
        self.best = found

    @staticmethod
    def _precedes(x: tuple | None, y: tuple | None) -> bool:
        """Both chains have a piece for each segment; the pieces before a shared link are equal."""
        own, other = [], []
        while x is not y and x is not None and y is not None:
            own.append(x[1])
            other.append(y[1])
            x, y = x[0], y[0]
        return "".join(reversed(own)) < "".join(reversed(other))

    def answer(self) -> tuple[int, str]:
        cost, _, pieces = min((cost, self._text(link), link) for state, (cost, link) in self.best.items() if state in FINAL)
        return cost, self._text(pieces)

    @staticmethod
    def _text(link: tuple | None) -> str:
        out = []
        while link is not None:
            out.append(link[1])
            link = link[0]
        return "".join(reversed(out))


def repaired_rows(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of what the audit leaves of rows (role, text)."""
    state, rows = START, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if state == USER else "u"]
        state = STEPS[state, role[0]]
        yield role, text


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) with NULL roles and texts as one space, damaged by the crc32 of conv_id:turn
    modulo 20: `copies` is 0 where a row goes and 2 where it is repeated."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ENDS, "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _hash(column: str) -> Column:
    return F.md5(F.col(column).cast("binary"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) without texts, equal ones together, with the fault of the first
    and of each further one: (conv_id, turn, role, text_hash, copies, fault, repeated)."""
    trimmed = F.btrim("text", F.lit(BLANK))
    own = F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(*ENDS), "truncated").otherwise("")
    slim = rows.select("conv_id", "turn", "role", _hash("text").alias("text_hash"), own.alias("own"), "copies")
    slim = slim.groupBy("conv_id", "turn", "role", "text_hash", "own").agg(F.sum("copies").alias("copies"))
    # a text that comes up in several turns is a duplicate in all but the first; NULL comes first
    here = slim.where("copies > 0")
    again = here.groupBy("conv_id", "role", "text_hash").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_hash").alias("t"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_hash") == F.col("t"))
    found = slim.join(again, same, "left")
    later = F.coalesce(F.col("first") < F.struct("turn"), F.lit(False))
    fault = lambda seen: F.when((F.col("own") != "blank") & seen, "duplicate").otherwise(F.col("own"))
    return found.select("conv_id", "turn", "role", "text_hash", "copies", fault(later).alias("fault"), fault(F.lit(True)).alias("repeated"))


COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")
#: Columns of a segment: its place, rows, least and greatest turn, first and last role initial, counts, cheapest audits.
SEGMENT = {
    **dict.fromkeys(("part", "segment", "n", "low", "high"), "bigint"),
    **dict.fromkeys(("opens", "closes"), "string"),
    **dict.fromkeys(COUNTS, "bigint"),
    "paths": "array<struct<first:int,last:int,cost:bigint,audit:string>>",
}
RESULT = {**dict.fromkeys(("gaps", *COUNTS[1:], "cost"), "bigint"), **dict.fromkeys(("audit", "repaired_sha256"), "string")}
ARROW = {
    "bigint": pa.int64(),
    "string": pa.string(),
    SEGMENT["paths"]: pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
}


def _schema(rows: DataFrame, columns: dict[str, str]) -> str:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ", ".join(f"{c} {t}" for c, t in {"conv_id": kind, **columns}.items())


def _batch(rows: list[tuple], columns: dict[str, str], conv: pa.DataType) -> pa.RecordBatch:
    types = [conv, *(ARROW[t] for t in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv_id", *columns])


@dataclass
class Segment:
    """A stretch of a conversation: what it adds to the counts, its ends, and the cheapest audits through it."""

    starts: tuple[int, ...]
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))
    rows: int = 0
    frontiers: dict[int, Frontier] = field(default_factory=dict)
    ends: dict[str, object] = field(default_factory=lambda: dict.fromkeys(("low", "high", "opens", "closes")))

    def __post_init__(self) -> None:
        self.frontiers = {s: Frontier(MODULUS, {s: (0, root())}) for s in self.starts}
        if START in self.frontiers:
            self.frontiers[START].insert()

    def row(self, turn: int | None, role: str, fault: str) -> None:
        initial, e = role[:1], self.ends
        if turn is not None and turn != e["high"]:
            self.counts["turns"] += 1
            e["low"] = turn if e["low"] is None else e["low"]
            e["high"] = turn
        if self.rows:
            self.counts["illegal"] += e["closes"] + initial not in LEGAL
        else:
            e["opens"] = initial
        e["closes"] = initial
        if fault:
            self.counts[fault] += 1
        self.rows += 1
        for f in self.frontiers.values():
            f.row(initial, fault in ("blank", "duplicate"), fault == "truncated")

    def paths(self) -> list[dict]:
        return [{"first": s, "last": last, "cost": cost, "audit": node.text()} for s, f in self.frontiers.items() for last, (cost, node) in f.best.items()]




def segments(rows: DataFrame, limit: int = SEGMENT_ROWS) -> DataFrame:
    """(conv_id, SEGMENT) for stretches of at most `limit` rows of each conversation, from the output of `judged`. A stretch
    that opens a task, or comes after another of its conversation, is worked off from every state."""
    columns = ["conv_id", "turn", "role", "text_hash", "copies", "fault", "repeated"]
    order = ["conv_id", "turn", "role", "text_hash"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, held, number, opened, out = None, None, 0, False, []

        def close() -> None:
            nonlocal number
            e = held.ends
            out.append((conv, part, number, held.rows, e["low"], e["high"], e["opens"], e["closes"], *held.counts.values(), held.paths()))
            number += 1

        for batch in batches:
            kind = batch.column("conv_id").type
            for name, turn, role, _, copies, fault, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or name != conv:
                    if held:
                        close()
                    conv, number, held = name, 0, Segment((START,) if opened else EVERY)
                    opened = True
                for k in range(copies):
                    if held.rows == limit:
                        close()
                        held = Segment(EVERY)
                    held.row(turn, role, repeated if k else fault)
                if len(out) >= 1024:
                    yield _batch(out, SEGMENT, kind)
                    out.clear()
        if held:
            close()
            yield _batch(out, SEGMENT, kind)

    return rows.select(columns).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, _schema(rows, SEGMENT))


def merge(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, RESULT) from the segments and the damaged rows of each conversation, which follow its segments, in order."""
    none = lambda columns: [F.lit(None).cast(t).alias(c) for c, t in columns.items()]
    text = {"turn": "bigint", "role": "string", "text_hash": "string", "text": "string", "copies": "int"}
    texts = rows.where("copies > 0").withColumn("text_hash", _hash("text")).select("conv_id", F.lit(1).alias("kind"), *text, *none(SEGMENT))
    heads = found.select("conv_id", F.lit(0).alias("kind"), *none(text), *SEGMENT)
    both = heads.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "segment", "turn", "role", "text_hash")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Merged | None = None
        for whole in batches:
            kind = whole.column("conv_id").type
            for lo in range(0, len(whole), 1024):
                out = []
                for row in whole.slice(lo, 1024).to_pylist():
                    if state is None or row["conv_id"] != state.conv:
                        if state:
                            out.append(state.result())
                        state = Merged(row["conv_id"])
                    if row["kind"]:
                        state.text(row)
                    else:
                        state.segment(row)
                if out:
                    yield _batch(out, RESULT, kind)
        if state:
            yield _batch([state.result()], RESULT, kind)

    return both.mapInArrow(scan, _schema(rows, RESULT))


class Merged:
    """One conversation, as its segments and then its rows come by."""

    def __init__(self, conv: object) -> None:
        self.conv, self.chain, self.counts = conv, Chain(), dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.closes = None
        self.audit: str | None = None
        self.cost, self.at, self.state, self.first = 0, 0, START, True
        self.sha = hashlib.sha256()

    def segment(self, s: dict) -> None:
        if not s["n"]:
            return
        for c in COUNTS:
            self.counts[c] += s[c]
        if s["low"] is not None:
            self.counts["turns"] -= s["low"] == self.high  # one turn on both sides
            self.low = s["low"] if self.low is None else self.low
            self.high = s["high"]
        if self.closes is not None:
            self.counts["illegal"] += self.closes + s["opens"] not in LEGAL
        self.closes = s["closes"]
        self.chain.add(s["paths"])

    def _write(self, role: str, text: str) -> None:
        self.sha.update(("" if self.first else "\n").encode() + role.encode() + b":")
        self.sha.update(text.encode())
        self.first, self.state = False, STEPS[self.state, role[0]]

    def _answer(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.chain.answer()

    def _inserted(self) -> None:
        while self.audit.startswith("I", self.at):
            self._write(ROLES["a" if self.state == USER else "u"], "")
            self.at += 1

    def text(self, row: dict) -> None:
        self._answer()
        for _ in range(row["copies"]):
            self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self._write(row["role"] if edit == "K" else ROLES["a" if self.state == USER else "u"], row["text"])

    def result(self) -> tuple:
        self._answer()
        self._inserted()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]
        return self.conv, gaps, *(self.counts[c] for c in COUNTS[1:]), self.cost, self.audit, self.sha.hexdigest()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, RESULT) for each conversation of `rows` (conv_id, turn, role, text, copies), as `damaged` gives them.

    Rows are taken by turn, NULL first; ties by role and then by the text's md5, so equal rows are neighbours. `copies` says how
    often a row stands there; 0 names its conversation only, and a conversation without rows has zeros, an empty audit and the
    hash of the empty string. A row's first fault counts: blank, duplicate (its role and text came before in the conversation),
    truncated (its last character that isn't white space is not one of .!?). A NULL conv_id is a conversation like others; an
    empty role has no initial and can't be kept. An empty table gives no rows; other columns are ignored.

    Equal texts are told by md5. The audit and the hash of a conversation are made in one task, in order, which the result asks
    for; the task holds the audit and one row."""
    rows = rows.select("conv_id", "turn", "role", "text", "copies")
    return merge(segments(judged(rows)), rows)
