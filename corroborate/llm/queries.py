"""The queries of this package over the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base, decontamination, langid, media, negatives, periodic, pii, quality, repeats, secret_scan, sentencepiece_fst, simhash, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learn = base.not_held_out(F.col("doc_id"))
    chain = toxicity.fit(docs, labels.filter(learn).select("doc_id", "toxic"), ["toxic"], derived=2)
    return toxicity.score(docs, chain, keep=["doc_id"]).withColumn("held_out", base.held_out(F.col("doc_id")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(base.not_held_out(F.col("doc_id"))))
    found = langid.predict(docs, model, keep=["doc_id"])
    return found.select("doc_id", base.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def _span_text(only_base: bool) -> Column:
    spans = F.filter("spans", lambda s: s["base"]) if only_base else F.col("spans")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _n(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: (s["kind"] == kind) & s["base"])).cast("long").alias(f"n_{kind}")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs), keep=["doc_id"])
    return found.select("doc_id", *[_n(k) for k in pii.KINDS], F.sha2(_span_text(True), 256).alias("base_sha256"), _span_text(False).alias("spans"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.find(docs, secret_scan.fit(docs), keep=["doc_id"])
    return found.select("doc_id", *[_n(k) for k in secret_scan.KINDS], F.sha2(_span_text(True), 256).alias("base_sha256"), _span_text(False).alias("spans"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(base.not_held_out(F.col("doc_id"))))
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", base.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(_table(spark, sf_dir, "documents"), keep=["doc_id"], with_media=False)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def tokenizer_model(spark: SparkSession) -> bytes:
    """The model named in the setting corroborate.sentencepiece.model, else the installed public one."""
    path = spark.conf.get("corroborate.sentencepiece.model", None)
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_fst.read_model(spark, str(path))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode(_table(spark, sf_dir, "documents"), tokenizer_model(spark), keep=["doc_id"], with_ids=False, check=True)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding", F.col("id") % 100 == 0)


def periodic_words(doc_id: int | None, words: list) -> list:
    """The words of every tenth document, by crc32 of its id, go round from some word on, as the query asks."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(_table(spark, sf_dir, "documents"), keep=["doc_id"], rewrite=periodic_words, rewrite_by="doc_id")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    milli = F.floor(-1000 * best["l"] / best["period"])
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), (-best["l"]).alias("length"), best["period"].alias("period"), milli.alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.RULES, keep=["page_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_language, op3_pii, op4_secrets, op5_quality, op6_media, op7_decontamination, op8_sentencepiece, op9_simhash, op10_repeats, op11_hard_negatives, op12_periodic, op13_url_filter)
}

ORACLES: dict[str, str] = {"op7_decontamination": decontamination.oracle(), "op11_hard_negatives": negatives.oracle(), "op13_url_filter": url_filter.oracle()}
