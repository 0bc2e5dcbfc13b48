import random
from pathlib import Path

import corpus_pipeline
from retentide.llm.decontaminate import find_contaminated
from tests.llm.test_ngram_jaccard import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw, n):
    return " ".join("".join(draw.choices("abcdefghilmnoprst", k=draw.randrange(2, 8))) for _ in range(n))


def corpus():
    draw = random.Random(8)
    items = [(i, prose(draw, 30)) for i in range(5)]
    rows = []
    for i in range(120):
        words = prose(draw, draw.randrange(20, 120)).split()
        if i % 7 == 0:
            words[3:3] = ["idiot"] * 3
        rows.append((i, (" | " if i % 9 == 0 else " ").join(words)))
    for i in range(120, 150):  # near and exact copies
        words = rows[draw.randrange(20)][1].split()
        if i % 2:
            words[draw.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(150 + i, f"{prose(draw, 30)} {items[i][1]} {prose(draw, 30)}") for i in range(5)]
    rows += [(160 + i, f'{prose(draw, 30)} token = "{"".join(draw.choices("0123456789abcdef", k=40))}" {prose(draw, 9)} 192.168.100.{100 + i}') for i in range(10)]
    rows += [(180, None), (181, ""), (182, "123 !!"), (183, rows[0][1]), (183, rows[0][1])]
    return rows, items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 9 > 0), int(i % 7 == 0)) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("pipeline-*"))
    final = corpus_pipeline.run(spark, folder)
    (written,) = set(shared.glob("pipeline-*")) - before
    assert final.count() == spark.read.parquet(f"{written}/mixing").count()

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = [(i, t) for i, t in rows if i not in (180, 181, 182)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "decontamination", "secret_scan", "mixing"]
    for k, (name, _) in enumerate(corpus_pipeline.STAGES):
        columns, docs = docs.columns, spark.read.parquet(f"{written}/{name}")
        if name != "mixing":
            assert docs.columns == columns
        got = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        if name == "ngram_jaccard":
            first = {doc for doc, _, group in brute(expected) if doc == group}
            expected = sorted({(i, t) for i, t in expected if i in first})
        elif name == "decontamination":
            gone = {i for i, t in expected if any(item in t for _, item in items)}
            assert len(gone) == 5
            expected = [(i, t) for i, t in expected if i not in gone]
        elif name == "secret_scan":
            assert all(('token = "<secret>"' in t) == (160 <= i < 170) for i, t in got)
            assert [i for i, _ in got] == [i for i, _ in expected]
            expected = [(i, t) for i, t in got]
        elif name == "mixing":
            assert set(got) <= set(expected) and len(got) > 0.8 * len(expected)
            assert all(r["rate"] > 0 and 0 < r["n_tokens"] <= 2 * len(r["text"].split()) for r in docs.collect())
        if k < 4:
            assert got == sorted(expected), name


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
    assert find_contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")).collect() == []


def test_one_id_on_several_texts(spark, tmp_path):
    draw = random.Random(4)
    a, b, c, clean, item = (prose(draw, 60) for _ in range(5))
    near = lambda text, word: f"{text} {word}"
    # 7 is a near copy of 2 and also stands on another text; 3 names a group twice
    rows = [(2, a), (7, near(a, "end")), (7, clean), (3, b), (3, near(b, "end")), (9, near(b, "stop")), (None, c), (None, c), (None, near(c, "x")), (None, near(a, "x")), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_copy_stage(spark, docs, "").collect()]
    # copies without an id go as well; where no document of a group has one, one of them stays
    assert len([t for i, t in got if i is None and t.startswith(c)]) == 1 and (None, near(a, "x")) not in got and (None, "") in got
    assert len(got) == 5 and sorted(i for i, _ in got if i is not None) == [2, 3, 7]
    assert (2, a) in got and (7, clean) in got and len({(3, b), (3, near(b, "end"))} & set(got)) == 1

    folder = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(5, f"{a} {item} {b}"), (5, clean), (6, c), (None, f"{a} {item}")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = corpus_pipeline.decontamination_stage(spark, docs, folder)
    assert got.columns == docs.columns and {(r["doc_id"], r["text"]) for r in got.collect()} == {(5, clean), (6, c)}
