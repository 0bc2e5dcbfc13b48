import random
import zlib

import numpy as np

from retentide.llm import byte_cnn


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def slow_forward(net, text):
    """One text, byte by byte."""
    w, raw = net.weights, text.encode()
    size = -(-(len(raw) + byte_cnn.STRIDE) // byte_cnn.HALF) * byte_cnn.HALF
    padded = raw + bytes(size + byte_cnn.STRIDE - len(raw))
    kernel = np.concatenate([w["near"], w["far"]]).astype(np.float64)
    acts = np.array([w["embed"][list(padded[i : i + byte_cnn.WIDTH])].reshape(-1) @ kernel + w["bias"] for i in range(0, size, byte_cnn.STRIDE)])
    halves = [np.maximum(x.max(axis=0), 0) for x in np.split(acts, size // byte_cnn.HALF)]
    chunks = np.array([np.maximum(a, b) for a, b in zip(halves, halves[1:], strict=False)] or halves)
    hidden = np.maximum(np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ w["dense"] + w["dense_bias"], 0)
    return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))


def texts(seed=1, n=30):
    draw = random.Random(seed)
    return ["".join(draw.choices("abc éü|*", k=draw.choice([0, 3, 507, 508, 509, 512, 2000]))) for _ in range(n)]


def test_forward_covers_whole_texts():
    net = byte_cnn.ByteNet.fresh()
    own = texts()
    assert np.allclose(byte_cnn.forward(net, *packed(own)), [slow_forward(net, t) for t in own], atol=1e-5)
    # a change at the very end is seen
    assert byte_cnn.forward(net, *packed(["a" * 5000])) != byte_cnn.forward(net, *packed(["a" * 4990 + "|" * 10]))


def test_gradients_are_those_of_the_loss():
    net, own = byte_cnn.ByteNet.fresh(3), texts(2, 6)
    for k in net.weights:
        net.weights[k] = net.weights[k].astype(np.float64)
    y = np.array([1.0, 0, 1, 1, 0, 0])
    _, grad = byte_cnn.gradients(net, *packed(own), y)
    draw = np.random.default_rng(0)
    for k, w in net.weights.items():
        if k == "embed":
            continue
        for _ in range(4):
            at = tuple(draw.integers(0, s) for s in w.shape)
            old, step = w[at], 1e-3
            w[at] = old + step
            up = byte_cnn.gradients(net, *packed(own), y)[0]
            w[at] = old - step
            down = byte_cnn.gradients(net, *packed(own), y)[0]
            w[at] = old
            assert abs((up - down) / (2 * step) - grad[k][at]) < 2e-3 + 0.05 * abs(grad[k][at]), (k, at)


def test_held_out_accuracy_and_edge_cases(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghijkl", k=draw.randrange(2, 8)))
    rows = []
    for i in range(400):
        good = draw.random() < 0.6
        rows.append((i, (" " if good else " | ").join(word() for _ in range(draw.randrange(20, 300))), int(good)))
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(None, None, 1), (1000, "", 1), (1001, "x y " * 100000, 1), (1001, "x y " * 100000, 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, quality int")
    net = byte_cnn.fit_quality(docs, labels)
    scored = byte_cnn.score_quality(docs, net).collect()
    truth = {i: y for i, _, y in rows}
    scored_ids = {r["doc_id"]: r["score"] for r in scored}
    held = [(scored_ids[i], y) for i, y in truth.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95
    assert len(scored) == 404 and all(0 <= r["score"] <= 1 for r in scored)
    assert scored_ids[None] == scored_ids[1000]
    assert byte_cnn.score_quality(docs.limit(0), net).collect() == []
    even = byte_cnn.fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in byte_cnn.score_quality(docs, even).collect()} == {0.5}
