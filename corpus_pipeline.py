"""A training corpus from the ``documents`` table, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. Between
stages the rows are written as Parquet in the cluster's shared folder.

1. language_id: documents go whose language is undetermined or rejected.
2. near_dedup: of each group of near copies (5-word shingles, similarity of
   0.8 or more) the document with the smallest doc_id stays; of several texts
   under that doc_id in one group the one with the smallest digest.
3. suffix_dedup: byte strings of 50 and more that an earlier document holds are cut.
4. pseudonyms: personal data become format-preserving pseudonyms.
5. packing: every document gets its length bucket and batch.

A null text has no letter, so the first stage drops it. Rows with a null
doc_id stay and are no one's copy. Rows that repeat a doc_id and a text are one
document: near_dedup keeps one of them. Rows of one doc_id with different texts
are judged each by its own text. Extra columns pass through;
``n_chars`` follows the text. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import scratch_table
from cdcmart.llm.langid import keep_identified, train
from cdcmart.llm.minhash import near_duplicates, text_digest
from cdcmart.llm.packing import pack
from cdcmart.llm.pseudonyms import pseudonymise
from cdcmart.llm.suffix_dedup import remove_repeats
from cdcmart.session import ship_package

#: stands for the secret of a production run
KEY = "public-example-key"


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_identified(docs, train(docs, F.lit(True)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = near_duplicates(docs, percent=80, identity=True).where("kept AND doc_id IS NOT NULL")
    own = uuid.uuid4().hex  # no column of the table has such a name
    kept_id, kept_digest, digest = f"id_{own}", f"kept_{own}", f"digest_{own}"
    # of a component's rows with its smallest doc_id one text; a text without words is a component of its own
    one = (kept.groupBy("doc_id", F.coalesce(F.col("part").cast("string"), "digest").alias("group")).agg(F.min("digest").alias("digest"))
           .select(F.col("doc_id").alias(kept_id), F.col("digest").alias(kept_digest)).distinct())
    told = docs.withColumn(digest, text_digest(F.col("text")))
    named = told.join(one, (F.col("doc_id") == F.col(kept_id)) & (F.col(digest) == F.col(kept_digest)), "left_semi")
    return (named.dropDuplicates(["doc_id", digest]).drop(digest)
            .unionByName(docs.where(F.col("doc_id").isNull())))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeats(docs, carry=others)
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")}
    return _counted(cut.select(*(columns[c].alias(c) if c in columns else F.col("carried")[c].alias(c) for c in docs.columns)))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pseudonymise(docs, KEY, count_col=None))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, buckets=16, token_budget=32_768)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("pseudonyms", pseudonyms), ("packing", packing)]
#: language identification, MinHash and the keyed networks have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
