"""A corpus from documents: five stages, each on all that the one before it kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, shared_dir, sides_by_size, write_table

#: Ids that may be sent to every task (16 bytes each); more are joined by shuffle.
SENT_IDS = 4_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; those without any text stay."""
    from tidemark.llm.quality import classify

    judged = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("n_bytes > 0 and not keep")
    gone = write_table(judged.select(F.col("doc_id").alias("_doc")).distinct(), "pipeline-rejected")
    return docs.join(sides_by_size(gone, gone.count(), SENT_IDS), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal or similar lines one stays; documents without a line of their own go."""
    from tidemark.llm.lines import dedup

    cut = dedup(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component stays, once; documents without an id stay."""
    from tidemark.llm.simhash import near_duplicates as groups

    of = write_table(groups(docs).where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("n")), "pipeline-groups")
    gone = of.where("doc_id <> first").select(F.col("doc_id").alias("_doc"))
    kept = docs.join(sides_by_size(gone, gone.count(), SENT_IDS), F.col("doc_id") == F.col("_doc"), "left_anti")
    if of.where("n > 1").limit(1).count():  # rows that repeat an id
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
    return kept.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows with equal id and text are taken together."""
    from tidemark.llm.mixing import mix, row_key

    taken = write_table(mix(docs).groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key")).agg(F.sum("copies").cast("int").alias("_copies"), F.count("*").alias("_n")), "pipeline-taken")
    rows = docs.withColumn("_row", row_key())
    if taken.where("_n > 1").limit(1).count():  # repeated rows
        rows = rows.dropDuplicates(["doc_id", "_row"])
    wanted = taken.where("_copies > 0")
    both = rows.join(sides_by_size(wanted, wanted.count(), SENT_IDS), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_row") == F.col("_key")))
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of what is left, as digests, with the text they decode to."""
    from tidemark.llm.pieces import encode_digests
    from tidemark.llm.queries import vocabulary

    return encode_digests(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("pieces", pieces)]

#: SQL expresses none of these stages (a trained model, MinHash and SimHash links, drawn copies, a tokenizer); tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of *sf_dir*; each stage's result is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/pipeline-{k}-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
