"""Registered text queries against plain versions of what they compute, and samples and backgrounds that hold the unexpected."""

import hashlib
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from corroborate.llm import base, decontamination, langid, media, pii, pipeline, queries, secret_scan, sentencepiece_fst, toxicity

SF = "/root/testdata/sf0.001"
MASK = (1 << 32) - 1


def plain_words(text):
    """(start, end) of the runs of letters."""
    out, start = [], None
    for i, c in enumerate(text + " "):
        if unicodedata.category(c)[0] == "L":
            start = i if start is None else start
        elif start is not None:
            out.append((start, i))
            start = None
    return out


def plain_language(model, text):
    """(language, share of the letters): a word at a time, every language, a table of the best paths."""
    words = plain_words(text)
    if not words or not model.langs:
        return "und", 0.0
    low = [c.lower() if len(c.lower()) == 1 and ord(c) <= 0xFFFF else c for c in text]
    score, known = [], []
    for a, z in words:
        script = int(langid.script_of(np.array([ord(low[a])]))[0])
        total = np.zeros(len(model.langs))
        for i in range(a, z):
            x, y, w = (ord(low[j]) if a <= j < z else 32 for j in (i - 1, i, i + 1))
            h = (x * 0x9E3779B1 & MASK) ^ (y * 0x85EBCA6B & MASK) ^ (w * 0xC2B2AE35 & MASK)
            total += model.logp[((h ^ (h >> 15)) * 0x2C1B3C6D & MASK) >> 17].astype(np.float64)
        fits = model.allowed[script]
        known.append(bool(fits.any()))
        score.append(np.where(fits, total, total.min() - 50.0) if fits.any() else np.zeros(len(total)))
    value, back = score[0].copy(), []
    for s in score[1:]:
        stay, top = value.copy(), int(value.argmax())
        back.append([k if stay[k] >= stay[top] - model.switch_penalty else top for k in range(len(s))])
        value = np.array([max(stay[k], stay[top] - model.switch_penalty) for k in range(len(s))]) + s
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(b[path[-1]])
    weight = np.zeros(len(model.langs))
    for lang, ok, (a, z) in zip(reversed(path), known, words, strict=True):
        weight[lang] += (z - a) * ok
    return model.langs[int(weight.argmax())], weight.max() / sum(z - a for a, z in words)


def test_language_query_is_the_plain_path(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.filter(base.not_held_out(F.col("doc_id"))))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op2_language(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        lang, share = plain_language(model, t)
        assert got[i][0] == lang and abs(got[i][1] - share) < 1e-9, i


def test_language_stage_keeps_what_the_plain_path_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = ["Der Hund und die Katze und das Haus", "the dog and the cat and der Hund und die Katze und das Haus", "12 !!", "", None, "Привет мир", "x"]
    rows = docs.filter("doc_id < 80").unionByName(spark.createDataFrame([(9000 + i, t, None, None, 0) for i, t in enumerate(mixed)], docs.schema))
    model = langid.fit(rows.filter(base.not_held_out(F.col("doc_id"))))
    want = set()
    for r in rows.collect():
        lang, share = plain_language(model, r.text or "")
        if lang != "und" and share >= pipeline.LEAST_SHARE:
            want.add(r.doc_id)
    assert {r.doc_id for r in pipeline.language(spark, rows, SF).collect()} == want


def test_tokens_query_is_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=queries.tokenizer_model(spark))
    bytes_ = {i for i in range(sp.vocab_size()) if sp.is_byte(i)}
    got = {r.doc_id: (r.n_tokens, r.n_byte_tokens, r.ids_sha256) for r in queries.op8_sentencepiece(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = sp.encode(r.text or "")
        assert got[r.doc_id] == (len(ids), sum(i in bytes_ for i in ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()), r.doc_id


def some(rng, letters, n):
    return "".join(rng.choice(list(letters), n))


def test_keys_that_nobody_labelled_are_no_background():
    rng = np.random.default_rng(12)
    small, both = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda: f"pk_{some(rng, both, 6)}-{some(rng, both, 14)}"
    plain = sorted({some(rng, small, rng.integers(6, 14)) for _ in range(5500)} | {some(rng, "0123456789", 9) for _ in range(400)})
    hidden, labelled, asked = ([key() for _ in range(n)] for n in (400, 80, 300))
    for n in (0, 100, 400):
        model = secret_scan.fitted({"assign": labelled}, sorted([*plain, *hidden[:n]]))
        assert (model.likelihoods(asked)[:, 0] > model.cut["assign"]).mean() >= 0.95, n
        fresh = [some(rng, small, rng.integers(6, 14)) for _ in range(500)]
        assert (model.likelihoods(fresh)[:, 0] > model.cut["assign"]).mean() <= 0.01, n


def test_an_automaton_of_ordinary_words_marks_no_words():
    rng = np.random.default_rng(3)
    word = lambda: some(rng, "abcdefghijklmnopqrstuvwxyz", rng.integers(6, 12))
    model = secret_scan.fitted({"assign": [word() for _ in range(60)]}, sorted({word() for _ in range(4000)}))
    assert (model.likelihoods([word() for _ in range(1000)])[:, 0] > model.cut["assign"]).mean() <= 0.01


def test_backgrounds_of_nothing():
    assert secret_scan.fitted({}, []).cut == {} and secret_scan.fitted({"hex": ["ab" * 12]}, []).cut == {"hex": 1.0}


def test_a_repeated_key_takes_no_other_group_out_of_the_sample(spark):
    rows = spark.range(20000).selectExpr("CASE WHEN id < 15000 THEN 7 ELSE id END AS k", "CASE WHEN id < 17000 THEN 'a' ELSE 'b' END AS g")
    for n in (1, 7):
        got, sizes = base.bounded_sample(rows.repartition(n), "g", 200, ["k"])
        kept = sorted((r.g, r.k) for r in got.collect())
        assert sizes == {"a": 17000, "b": 3000} and got.columns == ["k", "g"]
        assert 100 <= sum(g == "b" for g, _ in kept) <= 300 and sum(g == "a" for g, _ in kept) <= 500
        first = kept if n == 1 else first
    assert kept == first


def test_two_labelled_categories_make_a_chain(spark):
    rng = np.random.default_rng(8)
    word = lambda p: [f"{p}{i}" for i in rng.integers(0, 40, 12)]
    rows = []
    for i in range(600):
        rude, threat = i % 3 == 0, i % 6 == 0
        rows.append((i, " ".join([*word("w"), *(["idiot"] if rude else []), *(["kill"] if threat else [])]), int(rude), int(threat)))
    df = spark.createDataFrame(rows, "doc_id long, text string, rude int, threat int").withColumn("p_rude", F.lit("clash"))
    learn, ask = df.filter("doc_id < 400"), df.filter("doc_id >= 400").drop("rude", "threat")
    chain = toxicity.fit(learn.select("doc_id", "text"), learn.select("doc_id", "rude", "threat"), ["rude", "threat"], per_class=400)
    assert list(chain.categories) == ["rude", "threat"]
    truth = {r[0]: r[2:] for r in rows}
    got = toxicity.score(ask, chain, keep=["doc_id"]).collect()
    assert np.mean([(r.rude, r.threat) == truth[r.doc_id] for r in got]) > 0.97 and len(got) == 200
    assert all(0 <= r.p_rude <= 1 and 0 <= r.p_threat <= 1 for r in got)


def test_empty_tables_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = none = docs.filter("doc_id < -1")
    for _, stage in pipeline.STAGES:
        now = stage(spark, now, SF)
        assert now.count() == 0
    assert media.store_texts(none, keep=["doc_id"]).count() == 0
    assert sentencepiece_fst.encode(none, queries.tokenizer_model(spark), keep=["doc_id"]).count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontamination.contaminated(docs, bench.filter("item_id < -1")).count() == 0 and decontamination.contaminated(none, bench).count() == 0
    assert pii.find(none, pii.fit(none)).count() == 0
