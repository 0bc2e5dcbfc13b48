"""The repair against all edits of short conversations; whole conversations against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from retentide.llm import conversation_repair as cr

ROLES = {"u": "user", "a": "assistant"}
VALID = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """(cost, audit, repaired roles) of the least audit, over every edit; rows are (role, must go, truncated)."""
    limit = 2 * len(rows)
    partial = [(0, "", "")]
    for k in range(len(rows) + 1):
        grown = partial
        while grown:
            grown = [(c + 5, a + "I", r + x) for c, a, r in grown if c + 5 <= limit for x in "ua"]
            partial = partial + grown
        if k == len(rows):
            break
        role, gone, cut = rows[k]
        new = []
        for c, a, r in partial:
            new.append((c + 2, a + "D", r))
            if not gone:
                if role[:1]:
                    new.append((c + 5 * cut, a + "K", r + role[0]))
                new += [(c + 1 + 5 * cut, a + "R", r + x) for x in "ua"]
        partial = [x for x in new if x[0] <= limit]
    return min(x for x in partial if VALID.fullmatch(x[2]))


def some_rows(draw, n):
    return [(draw.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), draw.random() < 0.15, draw.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("modulus", [cr.MODULUS, 3])
def test_cheapest_and_least_audit(modulus):
    """With a modulus of 3 nearly all hashes collide."""
    draw = random.Random(5)
    for _ in range(150):
        rows = some_rows(draw, draw.randrange(6))
        cost, audit, roles = brute(rows)
        assert cr.repair([(r[:1], g, t) for r, g, t in rows], modulus) == (cost, audit), rows


def test_long_ties_are_compared_by_their_common_prefix():
    draw = random.Random(6)
    for _ in range(20):
        rows = [(r[:1], g, t) for r, g, t in some_rows(draw, 300)]
        assert cr.repair(rows) == cr.repair(rows, 5)


def test_ancestors():
    draw = random.Random(1)
    text = "".join(draw.choice("DIKR") for _ in range(200))
    node, nodes = cr.root(), []
    for c in text:
        node = node.then(c)
        nodes.append(node)
    assert node.text() == text
    assert all(node.back(k).text() == text[: 200 - k] for k in (0, 1, 2, 63, 64, 199, 200))
    other = cr.root()
    for c in text[:150] + "D":
        other = other.then(c)
    assert cr.precedes(other, node) == (text[:150] + "D" < text)
    assert cr.precedes(nodes[10], node) and not cr.precedes(node, nodes[10]) and not cr.precedes(node, node)


def plain(rows):
    """The whole contract for a list of (conv_id, turn, role, text), as tuples by conv_id."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cr.repair([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(own, faults, strict=True)])
        left, state = [], ""
        rest = iter(own)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(rest)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            left.append(f"{role}:{text}")
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(own))
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def log():
    draw = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(draw.randrange(1, 9)):
            role = ["user", "assistant"][turn % 2] if draw.random() < 0.8 else draw.choice(["system", "tool", None, "", "user"])
            text = draw.choice([f"Turn {turn}.", "Same!", "no end", "", None, " \t\n", "über alles? ", "Ends. \n"])
            rows.append((conv, turn if draw.random() < 0.95 else None, role, text))
    rows += [(7, 2, "user", "Same!")] * 3  # repeated rows
    rows += [(1000, t, "user" if t % 2 else "assistant", f"long {t % 50}" + "." * (t % 3)) for t in range(700)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def results(df):
    return {r.conv_id: tuple(r[c] for c in cr.RESULT) for r in df.collect()}


def test_conversations(spark):
    rows = log()
    want = plain(rows)
    rows_df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS kind", "1 AS part")
    assert results(cr.repair_conversations(cr.damaged(rows_df))) == want
    assert any("R" in w[6] for w in want.values()) and any("D" in w[6] for w in want.values())


def test_stretches_of_a_conversation_are_put_together(spark):
    """Segments of three rows over many tasks give the same as the whole."""
    rows = cr.damaged(spark.createDataFrame(log(), SCHEMA))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = results(cr.merge(cr.segments(cr.judged(rows), 3), rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert cut == plain(log())


def test_conversations_without_rows_are_returned(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    found = results(cr.repair_conversations(cr.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))))
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert cr.repair_conversations(cr.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_very_long_texts(spark):
    text = "word " * 400_000
    rows = [(1, 0, "user", text + "."), (1, 1, "assistant", text)]
    assert results(cr.repair_conversations(cr.damaged(spark.createDataFrame(rows, SCHEMA)))) == plain(rows)
