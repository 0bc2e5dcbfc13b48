import random

import numpy as np
import pyarrow as pa

from retentide.llm import language_id
from retentide.llm.arrow_text import slices
from retentide.llm.sampling import split_part

SOUNDS = {"xx": "ba be bi bo bu da de di do du".split(), "yy": "kräz stro plim quent gör schta vlo".split(), "zz": "ñola ción ueda mente rraz illo".split()}


def prose(draw, lang, n):
    return " ".join("".join(draw.choices(SOUNDS[lang], k=draw.randrange(1, 4))) for _ in range(n))


def documents(seed=2, n=150):
    draw = random.Random(seed)
    return [(i, prose(draw, lang, draw.randrange(3, 80)), lang) for i in range(n) for lang in [draw.choice(list(SOUNDS))]]


def fitted(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string")
    return language_id.fit_languages(language_id.training_rows(docs))


def test_held_out_accuracy(spark):
    model = fitted(spark)
    assert model.languages == ["xx", "yy", "zz"]
    docs = spark.createDataFrame(documents(9), "doc_id long, text string, lang string").where(split_part(language_id.F.col("doc_id"), 4) == 2)
    rows = language_id.predict_languages(docs, model).collect()
    assert rows and all(r["lang"] == r["lang_pred"] and r["score"] > 0.9 for r in rows)


def test_mixtures_and_their_sets(spark):
    model, draw = fitted(spark), random.Random(4)
    text = prose(draw, "xx", 60) + " " + prose(draw, "zz", 30)
    row = language_id.predict_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row["lang_pred"] == "xx" and set(row["shares"]) == {"xx", "zz"}
    assert abs(row["score"] - 2 / 3) < 0.06


def test_em_never_lowers_the_likelihood(spark):
    model, draw = fitted(spark), random.Random(5)
    (_, _, data, at), *_ = slices(pa.array([prose(draw, "xx", 20) + " " + prose(draw, "yy", 20)]))
    like = np.random.default_rng(0).random((40, 3)).astype(np.float32)
    fits = [language_id._em(like, np.array([0, 15, 40]), np.full((2, 3), 1 / 3, np.float32), k)[1] for k in range(1, 8)]
    assert all((b >= a - 1e-4).all() for a, b in zip(fits, fits[1:], strict=False))
    assert np.allclose(language_id.mixtures(data, at, model).sum(axis=1), 1, atol=1e-4)


def test_edge_cases(spark):
    model = fitted(spark)
    rows = [(1, None, "a"), (2, "", "a"), (3, "12 34 !?", "a"), (None, "ba be bi", "a"), (5, "µ", "a"), (6, "bu " * 200000, "a"), (6, "bu " * 200000, "a"), (7, "—“”…", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = language_id.predict_languages(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "shares"]
    found = [(r["doc_id"], r["lang_pred"]) for r in got.collect()]
    assert found[:4] == [(1, "und"), (2, "und"), (3, "und"), (None, "xx")]
    assert found[4][1] in model.languages and found[5:] == [(6, "xx"), (6, "xx"), (7, "und")]
    assert language_id.predict_languages(docs.limit(0), model).collect() == []
    none = language_id.fit_languages(spark.createDataFrame([(1, "ba", None)], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language_id.predict_languages(docs, none).collect()} == {"und"}
