"""From crawled documents to a weighted training corpus: five stages over the table `documents`.

Each stage takes what its predecessor kept; all but the last return the columns of documents.

1. language_id: a document goes if no text is left to tell a language by, or if no language has a good part of it (LEAST_SHARE).
2. ngram_jaccard: of each group of near copies the document of the least doc_id stays, one text if it has several;
   where no document of the group has an id, one of them stays.
3. decontamination: documents that hold a benchmark item go.
4. secret_scan: secrets are replaced in the text; every document stays.
5. mixing: documents get rates that bring quality and toxicity to target weights; those of rate 0 go.

Stages 2 and 3 tell rows by doc_id and text, as an id can come with several texts or be NULL; rows that are
equal in both count as one document. Columns may have any names; a table without rows gives none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentide.llm import decontaminate, language_id, ngram_jaccard, secret_forest, soft_mixing
from retentide.llm.queries import TARGETS
from retentide.llm.spark_util import checkpoint, flag_keys, small_batches

LEAST_SHARE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of NULL or empty text go, as no language can be told; equal rows are judged alike; a NULL doc_id doesn't matter."""
    small_batches(spark)
    model = language_id.fit_languages(language_id.training_rows(docs))
    found = language_id.predict_languages(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


#: doc_id in joins, where NULL has to be equal to NULL.
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__key": ngram_jaccard.row_key()})


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the least doc_id (a NULL comes last), of its texts the one of the least key.
    Documents without words are in no group and stay, equal ones as one row."""
    small_batches(spark)
    groups = ngram_jaccard.similar_components(docs, keyed=True)
    rows = checkpoint(groups.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("key").alias("__key"), "component", (F.col("n_shingles") > 0).alias("full")))
    grouped = rows.where("full")
    first = grouped.groupBy("component").agg(F.min(F.struct(F.col("__id") == NO_ID, F.col("__id"), F.col("__key"))).alias("first"))
    gone = grouped.join(first, "component").where("__id <> first.__id OR __key <> first.__key").select("__id", "__key").distinct()
    # a row that is there twice is a group, too
    twice = checkpoint(rows.groupBy("__id", "__key").agg(F.count("*").alias("n")).where("n > 1").select("__id", "__key"))
    gone = checkpoint(gone)
    # bitmaps of the keys keep the texts of most others from being moved
    flagged = flag_keys(_keyed(docs), "__key", {"__may_go": gone, "__twice": twice})
    moved = flagged.where("__may_go OR __twice").join(gone, ["__id", "__key"], "left_anti").dropDuplicates(["__id", "__key"])
    return moved.unionByName(flagged.where("NOT (__may_go OR __twice)")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row goes if its text holds an item; each text is judged by itself, also where an id comes with several or is NULL."""
    small_batches(spark)
    rows = _keyed(docs).select(F.col("__key").alias("doc_id"), "text")
    found = decontaminate.find_contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    keys = checkpoint(found.select(F.col("doc_id").alias("__key")).distinct())
    flagged = flag_keys(_keyed(docs), "__key", {"__may_go": keys})
    kept = flagged.where("__may_go").join(keys, "__key", "left_anti")
    return kept.unionByName(flagged.where("NOT __may_go")).select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, secrets in its text are replaced; NULL and empty texts have none."""
    small_batches(spark)
    return secret_forest.redact(docs, secret_forest.fit_forest(checkpoint(secret_forest.find_candidates(docs))))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row gets its rate, also where doc_id is NULL or repeated; rows of rate 0 go."""
    small_batches(spark)
    labelled = soft_mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return soft_mixing.mix_documents(docs, labelled, TARGETS).where("rate > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("ngram_jaccard", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("mixing", mixing_stage),
]

#: Not expressible in SQL: the stages are held against brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each result is written to the shared folder and read again."""
    shared = spark.conf.get("spark.checkpoint.dir", f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    folder = f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
