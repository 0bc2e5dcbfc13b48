"""Measures against plain Python and the tokenisers themselves; bands on planted texts."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from retentide.llm import fertility
from retentide.llm.arrow_text import text_buffer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def vocabularies():
    return fertility.Vocabularies.load()


def plain(text, v):
    text = text or ""
    found = WORD.findall(text)
    wins = [tuple(found[k : k + 8]) for k in range(len(found) - 7)]
    times = Counter(wins)
    inside = {k + j for k, w in enumerate(wins) if times[w] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    ids = [k for w in found for lo in range(0, len(w), fertility.LONGEST_WORD) for k in v.processor.encode(w[lo : lo + fertility.LONGEST_WORD])]
    tokens = sum(len(v.encoding.encode_ordinary(" " + w[lo : lo + fertility.LONGEST_WORD])) for w in found for lo in range(0, len(w), fertility.LONGEST_WORD))
    n = len(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n, sum(v.processor.is_byte(k) for k in ids), tokens, pytest.approx(entropy, abs=1e-9))


def texts():
    draw = random.Random(8)
    pool = ["the", "House", "été", "世界", "дом", "a|b", "#x", "😀", "x" * 700, " ", "foo bar", "1,234.5"]
    out = ["", None, " \n\t", "one", "a b c d e f g h a b c d e f g h", "a b c d e f g h a b c d e f g", "same line\nsame line\n same line\n\n\nsame line"]
    for _ in range(80):
        n = draw.randrange(1, 60)
        out.append("".join(draw.choice(pool) + draw.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(n)))
    line = " ".join(draw.choice(pool[:5]) for _ in range(9))
    return [*out, "\n".join([line] * 5), "\n".join([line, "x", line])]


def test_measures_equal_plain_python(vocabularies, monkeypatch):
    rows = texts()
    monkeypatch.setattr(fertility, "MERGE_TOKENS", 50)
    columns = fertility.measure_texts(*text_buffer(pa.array(rows)), vocabularies)
    for k, text in enumerate(rows):
        assert tuple(c[k].item() for c in columns[:9]) == plain(text, vocabularies), text


def test_scripts(vocabularies):
    found = fertility.measure_texts(*text_buffer(pa.array(["Ein Haus", "дом и сад", "世界 12", "12 34", "한국어", "Ωμέγα"])), vocabularies)[9]
    assert found.tolist() == ["latin", "cyrillic", "cjk", "none", "hangul", "greek"]


def prose(draw, n):
    return " ".join(draw.choice("the house of a man and his dog went down to see that river because it was warm there every single day".split()) for _ in range(n)) + "."


def test_bands_reject_what_no_prose_looks_like(spark, make_docs):
    draw = random.Random(3)
    rows = [(k, prose(draw, 100)) for k in range(400)]
    hexes = " ".join("%016x" % draw.getrandbits(64) for _ in range(40))
    odd = {
        1000: "ዒ᚛𐌰" * 60 + " " + " ".join(["ዒ᚛𐌰"] * 40 + list("abcdefgh" * 4)),  # bytes of the fallback
        1001: hexes,
        1002: " ".join(random.Random(1).choices(["yes", "no"], k=100)),  # hardly any entropy
        1003: "few words",
        1004: "a b c d e f g h " * 10,
    }
    found = {r.doc_id: r for r in fertility.apply_rules(make_docs(rows + list(odd.items()))).collect()}
    assert all(found[k].kept for k in range(400))
    assert not any(found[k].kept for k in odd)
    assert "byte_share" in found[1000].outside and "chars_per_piece" in found[1001].outside
    assert "token_entropy" in found[1002].outside or found[1002].base_failed
    assert found[1003].base_failed and found[1004].base_failed and not found[1001].base_failed


def test_bands_are_per_language(spark, make_docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(fertility, "BAND_ROWS", 50)
    draw = random.Random(4)
    coded = lambda: " ".join("%08x" % draw.getrandbits(32) for _ in range(60))
    docs = make_docs([(k, prose(draw, 100)) for k in range(100)]).union(make_docs([(k, coded()) for k in range(100, 200)], lang="xx"))
    docs = docs.union(make_docs([(200, coded())])).union(make_docs([(201, prose(draw, 100))], lang="rare"))
    kept = {r.doc_id: r.kept for r in fertility.apply_rules(docs, language=F.col("lang")).collect()}
    assert all(kept[k] for k in range(200)) and not kept[200]
    assert kept[201]  # a language of too few documents is judged by its script


def test_odd_rows(spark):
    rows = [(None, "word " * 5, "a"), (1, None, None), (1, "", "a"), (2, "x" * 100_000 + " " + "y z " * 30_000, None), (2, "same", "a"), (2, "same", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `group` string").selectExpr("*", "1 AS length", "2 AS script", "3 AS kept", "4 AS base_failed")
    found = fertility.apply_rules(docs).collect()
    assert len(found) == 6 and sum(r.doc_id is None for r in found) == 1
    assert [r.n_words for r in sorted(found, key=lambda r: (r.doc_id or 0, r.n_words))] == [5, 0, 0, 1, 1, 60_001]
    assert not any(r.kept for r in found if r.n_words < 20)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fertility.apply_rules(empty).collect() == []


def test_more_bands_than_are_broadcast(spark, make_docs, monkeypatch):
    draw = random.Random(5)
    docs = make_docs([(k, prose(draw, 60)) for k in range(150)])
    want = sorted(map(tuple, fertility.apply_rules(docs).drop("outside").collect()))
    monkeypatch.setattr(fertility, "BROADCAST_BANDS", -1)
    assert sorted(map(tuple, fertility.apply_rules(docs).drop("outside").collect())) == want
