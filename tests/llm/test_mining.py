"""Hard negatives, periodic runs and url rules against brute force and DuckDB, with the edge cases of each contract."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corroborate.llm import negatives, periodic, queries, url_filter

SF = "/root/testdata/sf0.001"


def by_sql(sql, **tables):
    db = duckdb.connect()
    for name, x in tables.items():
        if isinstance(x, str):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{x}'")
        else:
            db.register(name, x)
    r = db.sql(sql)
    return r.columns, r.fetchall()


def mined(rows, label=None):
    """Plain hard negatives of (id, label, vector) rows."""
    good = {}
    for i, lab, v in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = min(good.get(i, (lab, v)), (lab, v))
    q = {i: (lab, [math.floor(256 * x) for x in v]) for i, (lab, v) in good.items()}
    dot = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=False))))
    out = set()
    for a, (lab, v) in q.items():
        if a % 10:
            continue
        scored = sorted((-dot(v, w), i) for i, (_, w) in q.items() if i != a)
        for s, p in [x for x in scored if q[x[1]][0] == lab][:5]:
            fits = [(t, n) for t, n in scored if q[n][0] != lab and -80 * s <= -100 * t <= -100 * s][:5]
            out |= {(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(fits)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, lab int, v array<double>").withColumn("score", F.lit("clash"))


def run_negatives(df):
    return {tuple(r) for r in negatives.mine(df, "vec_id", F.col("lab"), "v", F.col("id") % 10 == 0).collect()}


def test_hard_negatives_of_odd_rows(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(3), [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(-20, 160)]
    rows += [(i, i % 2, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 330)]  # many equal scores
    rows += [(400, None, [1.0, 0.0, 0.0, 0.0]), (401, 1, None), (402, 1, [float("nan"), 0.0, 0.0, 0.0]), (403, 2, [float("inf"), 0.0, 0.0, 0.0]), (404, 1, [None, 1.0]), (None, 1, [1.0, 1.0, 1.0, 1.0])]
    rows += [(410, 1, []), (420, 1, [0.25]), (421, 0, [0.25, 0.0, 0.0, 0.0, 3.0]), rows[25], rows[25], (0, 2, [0.9, 0.9, 0.9, 0.9])]
    monkeypatch.setattr(negatives, "CELL_ROWS", 64)
    monkeypatch.setattr(negatives, "CELL_ANCHORS", 16)
    got = run_negatives(vectors(spark, rows))
    assert got == mined(rows) and len(got) > 100


def test_hard_negatives_of_large_components(spark):
    rows = [(10, 0, [1e30, 1.0]), (11, 0, [1e4, 5.0]), (12, 1, [1e4, 1.0]), (13, 1, [9e3, -7.0]), (20, 0, [3e6, 2e6]), (21, 0, [3e6, 1e6]), (22, 1, [3e6, 9e5])]
    assert run_negatives(vectors(spark, rows)) == mined(rows)


def test_hard_negatives_of_empty_tables(spark):
    assert run_negatives(vectors(spark, [])) == set()
    assert run_negatives(vectors(spark, [(1, 0, [1.0])])) == set()
    assert run_negatives(vectors(spark, [(10, 0, [1.0]), (11, 1, [1.0])])) == set()


def test_hard_negatives_as_in_sql(spark):
    cols, rows = by_sql(queries.ORACLES["op11_hard_negatives"], embeddings=f"{SF}/embeddings.parquet")
    df = queries.op11_hard_negatives(spark, SF)
    assert {tuple(r) for r in df.select(*cols).collect()} == set(rows) and rows


def test_packed_keys_are_in_order():
    import pyarrow as pa

    rnd = random.Random(1)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1, 1]
    some = [(rnd.choice(ends), rnd.choice(ends), rnd.choice(ends)) for _ in range(200)]
    keys = next(negatives._packed(0)([pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some, strict=True)], names=["a", "s", "i"])])).column(0).to_pylist()
    by_key = [x for _, x in sorted(zip(keys, some, strict=True))]
    assert by_key == sorted(some, key=lambda x: (x[0], -x[1], x[2]))


def plain_runs(words, min_words=6, min_exponent=4):
    best = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            s = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - s + q >= max(min_words, min_exponent * q):
                best.setdefault((s - q, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def plain_row(doc_id, text):
    words = queries.periodic_words(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda x: (x[0], x[2])))
    top = min(((-n, s, q) for s, n, q in found), default=None)
    head = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    return (len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


COLS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_query_is_brute_force(spark):
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in queries.op12_periodic(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert got == {r.doc_id: plain_row(r.doc_id, r.text) for r in docs}
    assert sum(x[0] > 0 for x in got.values()) > 5


@pytest.mark.parametrize(("min_words", "min_exponent"), [(6, 4), (6, 3), (2, 3), (9, 5)])
def test_runs_of_few_words(min_words, min_exponent):
    rnd, texts = random.Random(min_words), []
    for _ in range(1500):
        n, k = rnd.randint(0, 70), rnd.randint(1, 4)
        w = [rnd.randrange(k) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a = rnd.randrange(n)
            p = 1 + (n - a) // rnd.randint(3, 9)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            w[rnd.randrange(n)] = rnd.choice([9, w[0]])
        texts.append(w)
    texts += [[1] * 5000, [1, 2, 1, 3] * 700 + [1, 1, 1, 1, 1, 1], []]
    for words, opened in zip(texts, periodic.openings(texts, min_exponent), strict=True):
        assert sorted(periodic.runs(words, opened, min_words, min_exponent)) == plain_runs(words, min_words, min_exponent)


def test_periodic_of_odd_rows(spark):
    long = "a b c d e f g " * 40000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "la la la la la la la"), (4, "la la la la la la la"), (None, "x " * 9), (5, long), (6, "la\u00a0la la\u00a0la"), (7, "é\x0bé\x0cé é\ré é\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit("clash"))
    out = periodic.find(df)
    assert out.columns == ["doc_id", "runs", "collapsed"]
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=repr)
    want = sorted(((i or 0, plain_runs((t or "").encode().split()) if t != long else [(0, 280000, 7)], {4: "la", None: "x", 5: "a b c d e f g", 6: "la\u00a0la la\u00a0la", 7: "é"}.get(i, "")) for i, t in rows), key=repr)
    assert got == want
    assert periodic.find(df.filter("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        periodic.find(df, min_exponent=2)


def test_urls_as_in_sql(spark):
    cols, rows = by_sql(queries.ORACLES["op13_url_filter"], pages=f"{SF}/pages.parquet")
    assert sorted(map(repr, (tuple(r) for r in queries.op13_url_filter(spark, SF).select(*cols).collect()))) == sorted(map(repr, rows))


URLS = [
    ("http://com/", "com", "/", "com/", "allow"), ("http://a.COM", "a.com", "", None, None), ("https://www.Example.com/en/1?x=/fr/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/1", "m.example.com", "/en/1", "example.com/en/", "block"), ("https://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"), ("ftp://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("x://net/fr/", "net", "/fr/", "net/fr/", "block"), ("x://a.net/fr", "a.net", "/fr", None, None), ("net/fr/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("http://a.com:80/", "a.com:80", "/", None, None), ("http://b.com?u=http://c.net/fr/", "b.com", "", None, None), ("http://b.com#/en/", "b.com", "", None, None), ("http://É.com/ö", "É.com", "/ö", "com/", "allow"), ("a://b\n.com/\n?", "b\n.com", "/\n", "com/", "allow"),
]


def test_given_rules(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("verdict", F.lit("clash")).withColumn("__n", F.lit(1))
    out = {r.page_id: r for r in url_filter.judge(df, url_filter.RULES).collect()}
    assert len(out) == len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert verdict in (None, out[i].verdict)


def test_mined_rules(spark):
    urls = [f"http://s{i}.spam-farm.net/fr/{i}" for i in range(40)] + [f"http://s{i}.good.com/de/{i}" for i in range(60)]
    urls += ["http://s1.spam-farm.org/it/1", "http://s1.good.org/it/1", "http://other.org/", "http://s1.good.org/it/" + "x/" * 4000] + ["http://s1.spam-farm.org/it/1"] * 200
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = [r.verdict for r in url_filter.judge(df, url_filter.RULES).orderBy("page_id").collect()]
    assert got[100:104] == ["block", "allow", "allow", "allow"] and set(got[104:]) == {"block"}
    cols, rows = by_sql(queries.ORACLES["op13_url_filter"], pages=df.toPandas())
    at = cols.index("verdict"), cols.index("page_id")
    assert got == [r[at[0]] for r in sorted(rows, key=lambda r: r[at[1]])]
    none = df.filter("page_id < 0")
    assert url_filter.judge(none, url_filter.RULES).count() == 0
    assert [r.verdict for r in url_filter.judge(spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string"), url_filter.RULES).collect()] == ["allow"]


def test_a_long_common_path_does_not_double_the_combinations(spark):
    deep = "/".join(f"d{i}x" for i in range(60))
    df = spark.range(200).select(F.col("id").alias("page_id"), F.concat(F.lit(f"http://a.com/{deep}/"), F.col("id").cast("string")).alias("url"))
    assert {r.verdict for r in url_filter.judge(df, url_filter.RULES).collect()} == {"allow"}


def test_scores_are_exact():
    rnd = np.random.default_rng(3)
    for most in (200, 1 << 20, 1 << 40):
        a, b = np.floor(rnd.uniform(-most, most, (5, 9))), np.floor(rnd.uniform(-most, most, (7, 9)))
        want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(r, s, strict=True)))) for s in b] for r in a]
        assert negatives._scores(a, b).tolist() == want
