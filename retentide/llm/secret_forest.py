"""Secret scanning: candidates by pattern, false positives removed by a random forest.

A candidate is a long run of the characters that keys are made of, with a digit, or whatever is assigned
to a secret's name, of any length. What tells keys from other such values is learned from labelled findings: length, character transitions, how much of it words
of a dictionary cover, whether it is part of a path or URL, and the neighbouring words.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.llm.sampling import cut_by_hash
from retentide.llm.spark_util import checkpoint, shared_folder

#: Labelled findings that the forest is fitted on, at most; its size.
LABELLED_ROWS, TREES, DEPTH = 20000, 30, 8
THRESHOLD = 0.5
SHORTEST = 12
#: A `=` parts a name from its value, so a run holds it only at its end, as padding.
_RUN = rf"[A-Za-z0-9+/_.@-]{{{SHORTEST},}}"
_CANDIDATE = re.compile(_RUN + r"""(?:={1,2}(?![\w+/="'`]))?""")
_WORD = re.compile(r"[^\W\d_]+")
#: Words whose presence speaks for text that people wrote.
DICTIONARY = (
    "example sample test dummy fake user admin name mail email com org net www http https file files path home index main page image img version build config data "
    "date time local host server client public static assets src lib node module package license copyright commit release the and for with from this that not null "
    "true false default value string number count size type list item key token secret password change your here insert redacted xxxx abcd 1234"
).split()
_KNOWN = re.compile("|".join(sorted(DICTIONARY, key=len, reverse=True)))
#: Names that a secret is assigned to, and well-known key formats.
_SECRET_NAME = "(?:token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)s?"
_ASSIGNED = re.compile(rf"""(?i)\b[\w.-]*{_SECRET_NAME}["'`]?\]?\s*(?:=>|:=|={{1,3}}|:|\s)\s*(?:(?:bearer|basic)\s+)?["'`]?$""")
#: What comes before an assigned value; the same to Python and to Java.
_ASSIGNS = rf"""(?i)(?:{_SECRET_NAME}["'`]?\]?[ \t]*(?:=>|:=|={{1,3}}|:(?!:))|--[A-Za-z0-9_-]{{0,30}}{_SECRET_NAME}[ \t])"""
_VALUE = re.compile(_ASSIGNS.replace("(?i)", "(?ai)") + r"""[ \t]*(?:(?:bearer|basic)[ \t]+)?(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`|["'`]?([^\s"'`,;&<>(){}\[\]]+))""")
_LITERAL = re.compile(r"(?i)(?:null|none|nil|true|false|undefined|\d{1,5}|[\W_]+)$")
_REFERENCE = re.compile(r"\$?[^\W\d][^\W\d]*(?:[./-][^\W\d]+)*$")
_FORMAT = re.compile(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[baprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$")
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|changeme|your|redacted|placeholder|x{4}|(.)\1{7}")
_EXTENSION = re.compile(r"\.[a-z]{1,5}$")
WORD_SLOTS = 12


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(value: str, before: str, after: str) -> list[float]:
    """Numbers that the forest sees: of the candidate, of the text before it and after it."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    counts = [kinds.count(k) / n for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    hexes = sum(c in "0123456789abcdefABCDEF" for c in value) / n
    entropy = -sum(p * math.log2(p) for p in (value.count(c) / n for c in set(value)))
    repeats = sum(a == b for a, b in zip(value, value[1:], strict=False)) / n
    steps = sum(abs(ord(b) - ord(a)) == 1 for a, b in zip(value, value[1:], strict=False)) / n
    vowels = sum(c in "aeiouAEIOU" for c in value) / n
    covered = sum(len(m) for m in _KNOWN.findall(value.lower())) / n
    path = float(value.count("/")), float("//" in before[-40:].split(" ")[-1] or "//" in value), float(bool(_EXTENSION.search(value))), float("@" in value), float(value.count("."))
    quoted = float(before[-1:] in "\"'`" and before != ""), float(after[:1] in "\"'`" and after != "")
    assigned = before.rstrip("\"'` ")[-1:]
    near = [0.0] * (2 * WORD_SLOTS)
    for k, found in enumerate((_WORD.findall(before)[-2:], _WORD.findall(after)[:1])):
        for word in found:
            near[k * WORD_SLOTS + zlib.crc32(word.lower().encode()) % WORD_SLOTS] = 1.0
    return [float(n), *counts, changes / n, hexes, entropy, repeats, steps, vowels, covered, *path, *quoted, float(assigned == "="), float(assigned == ":"), *near]


def rule_label(value: str, before: str, after: str = "") -> int | None:
    """The label that a reviewer's rules give a finding: a known format, or a value assigned to a secret's
    name that isn't a placeholder, literal or call, is a secret; other findings next to no such name aren't.
    Unquoted words and phrases after such a name may be either and have no label."""
    if _PLACEHOLDER.search(value):
        return 0
    if _FORMAT.match(value):
        return 1
    if not _ASSIGNED.search(before):
        return 0
    quoted = before[-1:] in ("'", '"', "`")
    if _LITERAL.match(value) or not quoted and after[:1] in ("(", "["):
        return 0
    if any(c.isspace() for c in value) or not quoted and _REFERENCE.match(value):
        return None
    if len(value) >= 16:
        return 1
    # short values are only labelled where the name is sure to be assigned to, not just to stand before them
    return 1 if before.rstrip("\"'` \t")[-1:] in ("=", ":", ">") and not value.isdigit() else None


def _spans(text: str) -> Iterator[tuple[int, int]]:
    """Places of the assigned values and, between them, of the long runs with a digit."""
    at = 0
    for found in [*_VALUE.finditer(text), None]:
        a, b = found.span(found.lastindex) if found else (len(text), len(text))
        if found and found.lastindex == 4:
            while a < b and text[b - 1] == ".":
                b -= 1
        for run in _CANDIDATE.finditer(text, at, a):
            first, last = run.span()
            while first < last and text[first] in ".-@+":
                first += 1
            while first < last and text[last - 1] in ".-@+":
                last -= 1
            if last - first >= SHORTEST and any(c.isdigit() for c in text[first:last]):
                yield first, last
        if a < b:
            yield a, b
        at = b


def candidates(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(first, last, value, before, after) of each candidate; places are in characters."""
    for a, b in _spans(text):
        yield a, b, text[a:b], text[max(0, a - 60) : a], text[b : b + 30]


def _may_have_candidates(text: Column) -> Column:
    """False only for texts without a candidate, which needn't leave the JVM."""
    return F.coalesce(text.rlike("[0-9]") & text.rlike(_RUN) | text.rlike(_ASSIGNS), F.lit(False))


def find_candidates(docs: DataFrame, id_type: str = "long") -> DataFrame:
    """(doc_id, first, last, label, features) of each candidate in `docs` (doc_id, text); label is the rules'.
    doc_id is a long, or a string if `id_type` says so."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                rows += [(doc, a, b, rule_label(value, before, after), features(value, before, after)) for a, b, value, before, after in candidates(text.as_py())]
            if rows:
                types = (pa.int64() if id_type == "long" else pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "first", "last", "label", "features"])

    texts = docs.select(F.col("doc_id").cast(id_type).alias("doc_id"), "text").where(_may_have_candidates(F.col("text")))
    return texts.mapInArrow(scan, f"doc_id {id_type}, first int, last int, label int, features array<double>")


def fit_forest(findings: DataFrame, rows: int = LABELLED_ROWS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (label, features), about `rows` of each label at most, by a hash; None if
    either label is missing. Findings are counted and then sampled, so they should be a checkpoint."""
    spark = findings.sparkSession
    known = findings.where("label IN (0, 1)").select("label", "features")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    parts = [cut_by_hash(known.where(F.col("label") == k), F.xxhash64("features", "label"), rows, n) for k, n in sorted(totals.items())]
    sample = checkpoint(parts[0].union(parts[1]).select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("vector")).coalesce(4))
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    # both labels weigh the same
    weight = F.when(F.col("label") == 1, sum(counts.values()) / (2 * counts[1.0])).otherwise(sum(counts.values()) / (2 * counts[0.0]))
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=11)
    # a fitted model holds on to its training data and so to the session, which can't always go to tasks; one that was read doesn't
    folder = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    forest.fit(sample.withColumn("weight", weight)).write().save(folder)
    return RandomForestClassificationModel.load(folder)


def judge(findings: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """`findings` with probability and secret; without a forest the rules' label decides alone."""
    if model is None:
        probability = F.coalesce(F.col("label").cast("double"), F.lit(0.5))
        return findings.drop("features").withColumn("probability", probability).withColumn("secret", probability >= THRESHOLD)
    scored = model.transform(findings.withColumn("vector", array_to_vector("features")))
    return scored.select(*(c for c in findings.columns if c != "features"), vector_to_array("probability")[1].alias("probability")).withColumn("secret", F.col("probability") >= THRESHOLD)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, first, last, label, probability, secret) of each candidate in `docs` (doc_id, text).

    first and last are places in characters of the whole text. The forest learns from `labelled` (label,
    features) or, if not given, from the findings of `docs` by the rules. NULL and empty texts have no
    candidates; NULL ids are kept; repeated rows give their findings each; other columns are ignored."""
    findings = checkpoint(find_candidates(docs))
    return judge(findings, fit_forest(findings if labelled is None else labelled))


def redact(docs: DataFrame, model: RandomForestClassificationModel | None, mark: str = "<secret>") -> DataFrame:
    """`docs` (doc_id, text, n_chars, ...) with the secrets in text replaced by `mark`. n_chars follows the text.

    Rows whose text has no candidate aren't touched or moved. Texts are told by their md5, so doc_id may be NULL or repeated, and
    repeated rows stay; NULL and empty texts stay as they are; an empty table gives no rows; all columns are returned."""
    columns, key, found = docs.columns, "__md5", "__spans"
    touched = _may_have_candidates(F.col("text"))
    texts = docs.where(touched).select(F.md5(F.col("text").cast("binary")).alias("doc_id"), "text").dropDuplicates(["doc_id"])
    spans = judge(find_candidates(texts, "string"), model).where("secret")
    spans = spans.groupBy(F.col("doc_id").alias(key)).agg(F.sort_array(F.collect_list(F.struct("first", "last")), asc=False).alias(found))
    rest = docs.where(~touched)
    cut = lambda t, s: F.concat(F.substring(t, F.lit(1), s["first"]), F.lit(mark), F.substring(t, s["last"] + 1, F.length(t)))
    rows = docs.where(touched).withColumn(key, F.md5(F.col("text").cast("binary"))).join(spans, key, "left")
    clean = rows.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(F.aggregate(found, F.col("text"), cut)))
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return clean.select(*columns).unionByName(rest)
