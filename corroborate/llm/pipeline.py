"""A text-cleaning pipeline: language, near duplicates, benchmark passages, personal data, tokens.

Every stage takes the documents that the one before kept, written as Parquet and read again, and all but the last return the
columns of ``documents``. Extra columns pass through, whatever their names: an operator sees the id, the text and what it needs
under names of its own, and what it finds is joined to the row that it came with, in a struct.

Edge cases: texts that are null, empty or without a letter have no language and go at the first stage, as do texts in several languages
none of which has ``LEAST_SHARE`` of the letters. Very long texts are read whole by every stage. Of near copies the row of the least id stays, of
equal ids the one of the least key (a hash of id and text), rows without an id only where there is no other; of rows equal in id and text one stays. Later stages judge
each row by itself. Empty tables, of documents or of the benchmark, give empty results or drop nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base, decontamination, langid, pii, queries, sentencepiece_fst, simhash

#: Texts whose main language holds less than this share of the letters are rejected, as are texts without letters.
LEAST_SHARE = 0.5


def _wrapped(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and the whole row in a struct."""
    return docs.select(*needed, F.struct(*[F.col(base.quoted(c)) for c in docs.columns]).alias("__row__"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts with a known main language."""
    model = langid.fit(docs.filter(base.not_held_out(F.col("doc_id"))))
    found = langid.predict(_wrapped(docs, "text"), model, keep=["__row__"])
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("__row__.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near copies: that of the least id."""
    return simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that hold a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data; n_chars follows the new text."""
    found = pii.find(_wrapped(docs, "text"), pii.fit(docs), keep=["__row__"], redact=True)
    text = F.when(F.col("__row__.text").isNotNull(), F.col(pii.REDACTED))
    new = {"text": text, "n_chars": F.length(text)}
    return found.select(*[new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col(f"__row__.{base.quoted(f.name)}") for f in docs.schema])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    return sentencepiece_fst.encode(docs, queries.tokenizer_model(spark), keep=["doc_id"], with_ids=True, check=True)


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontaminate), ("pii_redaction", redact), ("sentencepiece_encoding", tokens)]

#: Models and connected components are not expressible in SQL; the tests hold each stage's kept rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = base.materialised(docs)
    return docs
