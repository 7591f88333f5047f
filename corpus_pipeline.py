"""The corpus pipeline: documents in, token ids of the clean ones out.

Each stage works on all that its predecessor kept, and writes its result to the shared
folder. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.llm import decontamination, pieces, secret_scan, simhash, toxicity
from driftline.llm.common import table
from driftline.shared import scratch_path, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays under the threshold, by the model learnt on the labels.

    Columns named like those of a score come back as they were.
    """
    model = toxicity.fit_held_in(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    own = {c: c if c == "text" else f"own_{c}" for c in docs.columns}
    scored = toxicity.score_documents(docs.select(*[F.col(c).alias(name) for c, name in own.items()]), model)
    return scored.where("predicted = 0").select(*[F.col(name).alias(c) for c, name in own.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose SimHash fingerprints link the document with the smallest id.

    Shingle length and bit distance are those of ``op10``.
    """
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontamination.remove_leaking(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking credentials in their texts are replaced, examples stay."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids): the token ids of every document's whole text."""
    coded = pieces.encode_documents(docs, keep=["lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


#: (name, function of session, documents and table folder), in order.
STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

#: Several stages learn or hash in ways SQL cannot express; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        target = scratch_path(spark, f"pipeline-{name}")
        # What a stage stages for itself goes once its result is written.
        with scratch_scope(spark):
            found = stage(spark, docs, sf_dir)
            schema = found.schema
            found.write.parquet(target)
        docs = spark.read.schema(schema).parquet(target)
    return docs
