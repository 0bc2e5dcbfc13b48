import random

import pytest
from pyspark.sql import functions as F

from retentide.llm.revisits import PERMITTED, canonical_url, resolve_revisits, with_payload

SCHEMA = "record_id long, url string, ts long, status int, digest string, headers map<string,string>, body string"


@pytest.mark.parametrize(
    "url,key",
    [
        ("http://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top", "www.example.com/a?a=1&b=2"),
        ("https://user@example.com/a/index.html?ref=x", "example.com/a"),
        ("https://example.com", "example.com"),
        ("https://example.com:8080//", "example.com:8080"),
        ("no url", None),
        ("", None),
        (None, None),
    ],
)
def test_canonical_url(spark, url, key):
    assert spark.createDataFrame([(url,)], "url string").select(canonical_url(F.col("url"))).first()[0] == key


def brute(rows):
    out = {}
    for r in rows:
        if r[3] != 304:
            continue
        own = {k.lower(): v for k, v in (r[5] or {}).items() if v is not None}
        earlier = [] if r[1] is None or r[2] is None else [x for x in rows if x[3] == 200 and x[1] == r[1] and x[2] is not None and x[2] < r[2]]
        if not earlier:
            out[r[0]] = ("missing", None, r[4], own)
            continue
        best = max(earlier, key=lambda x: (x[2], x[0]))
        stored = {k.lower(): v for k, v in (best[5] or {}).items() if v is not None}
        verdict = "unverified"
        for a, b in ((own.get("etag"), stored.get("etag")), (own.get("last-modified"), stored.get("last-modified")), (r[4], best[4])):
            if a is not None and b is not None:
                verdict = "resolved" if a.removeprefix("W/") == b.removeprefix("W/") else "mismatch"
                break
        merged = stored | {k: v for k, v in own.items() if k in PERMITTED} if verdict == "resolved" else own
        out[r[0]] = (verdict, best[0], (best[4] or r[4]) if verdict == "resolved" else r[4], merged)
    return out


def run(spark, rows, slot=3600):
    got = resolve_revisits(spark.createDataFrame(rows, SCHEMA).repartition(4), slot).collect()
    assert len(got) == len({r["record_id"] for r in got})
    return {r["record_id"]: (r["verdict"], r["refers_to"], r["digest"], r["headers"]) for r in got}


@pytest.mark.parametrize("slot", [10, 3600])
def test_equals_brute_force(spark, slot):
    draw = random.Random(slot)
    rows = []
    for i in range(400):
        headers = {"ETag": draw.choice(['"a"', 'W/"a"', '"b"', None]), "Last-Modified": draw.choice(["m", "n", None]), "Date": str(i), "Server": "s"}
        # one URL holds most records
        url = "http://hot.example/" if draw.random() < 0.6 else f"http://h{draw.randrange(20)}.example/"
        rows.append((i, url, draw.randrange(2000), draw.choice([200, 304, 304, 404]), draw.choice(["d", "e", None]), draw.choice([headers, {}, None, headers]), "b"))
    assert run(spark, rows, slot) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (1, "http://a.example/", 100, 200, "d", {"ETag": '"x"', "etag": '"x"', "Content-Type": "t", "Vary": "v"}, "body"),
        (2, "http://a.example/", 100, 304, "d", {"etag": '"x"'}, None),
        (3, "http://a.example/", 101, 304, "d", {"ETAG": 'W/"x"', "Server": "no"}, None),
        (4, None, 101, 304, "d", None, None),
        (5, "http://a.example/", None, 304, "d", {}, None),
        (6, "x" * 100000, 7, 304, None, {}, None),
        (7, "http://a.example/", 500, None, None, {}, None),
    ]
    got = run(spark, rows)
    assert {k: v[0] for k, v in got.items()} == {2: "missing", 3: "resolved", 4: "missing", 5: "missing", 6: "missing"}
    assert got[3][3] == {"content-type": "t", "vary": "v", "etag": 'W/"x"'}
    records = spark.createDataFrame(rows, SCHEMA)
    bodies = {r["record_id"]: r["body"] for r in with_payload(resolve_revisits(records), records, "body").collect()}
    assert bodies[3] == "body" and bodies[2] is None and len(bodies) == 5
    assert resolve_revisits(records.limit(0)).collect() == []
    twice = resolve_revisits(records.union(records)).where("record_id = 3").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    clash = records.withColumn("slot", F.lit(1)).withColumn("own", F.lit(1)).withColumn("url_key", F.lit("z"))
    assert resolve_revisits(clash).count() == 5
