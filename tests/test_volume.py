"""What queries send through shuffles grows with their input and results, not with copies of it."""

import random
from collections import Counter

from corroborate.operators import claims as cl
from corroborate.operators import docindex, evidence, grams


def shuffled(df):
    """The rows, and how many records the shuffles of their plan wrote."""
    rows = df.collect()

    def below(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return below(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return below(plan.plan())
        here = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        return here + sum(below(plan.children().apply(i)) for i in range(plan.children().size()))

    return rows, below(df._jdf.queryExecution().executedPlan())


def test_texts_are_not_shuffled_to_find_words(spark):
    texts = [(i, f"the quick {i} brown fox {i * 7}") for i in range(3000)]
    df = spark.createDataFrame(texts, "id int, text string")
    for words in (["the", "an", "fox 7"], [f"fox {i}" for i in range(200)]):
        got, n = shuffled(grams.containing(df, spark.createDataFrame([(w,) for w in words], "word string")))
        assert Counter((r.id, r.word) for r in got) == Counter((i, w) for i, t in texts for w in words if w in t)
        assert n == 0


def test_terms_of_many_queries_and_nodes_of_one_id(spark):
    rnd = random.Random(11)
    words = [f"{a}{b}{c}" for a in "kl" for b in "aeiou" for c in "mnprst"] + ["zzzz"] * 3
    say = lambda n: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, n)))
    nodes = [(f"d{i % 7}", None if i % 50 == 3 else i % 60, say(4), None if i % 9 == 0 else say(6).upper()) for i in range(240)]
    asked = [(q, say(5) if q % 4 else "kam KAM ken lit  x") for q in range(40)] + [(100, "kam"), (100, "ken lit"), (101, None), (102, "")]
    lists = {q: {w for p, t in asked if p == q and t for w in t.lower().split() if len(w) > 2} for q, _ in asked}
    want = set()
    for q, own in lists.items():
        n, said = Counter(), {}
        for d, i, title, summary in nodes:
            text = " ".join(x for x in (title, summary) if x is not None).lower()
            if hit := [w for w in own if w in text]:
                n[d, i] += len(hit)
                said.setdefault((d, i), []).append(summary)
        best = sorted((k for k in n if n[k] >= 2), key=lambda k: (-n[k], k[0], k[1] is not None, k[1] or 0))[:10]
        want |= {(q, *k, n[k], min((s for s in said[k] if s is not None), default=None), r) for r, k in enumerate(best, 1)}
    got = docindex.search_terms(spark.createDataFrame(nodes, "doc_id string, node_id int, title string, summary string"), spark.createDataFrame(asked, "query_id int, query string"))
    assert {(r.query_id, r.doc_id, r.node_id, r.n_terms, r.summary, r["rank"]) for r in got.collect()} == want and len(want) > 100


def test_queries_of_the_same_words_are_answered_once(spark):
    nodes = spark.createDataFrame([(f"d{i % 90:02}", i, "the fire", f"an oak {i % 3}") for i in range(3000)], "doc_id string, node_id int, title string, summary string")
    asked = spark.createDataFrame([(q, "an FIRE the" if q % 2 else "the the an fire") for q in range(200)], "query_id int, query string")
    got, n = shuffled(docindex.search_nodes(nodes, asked, 2, 1))
    assert {(r.query_id, r.doc_id, r.node_id, r.score, r["rank"]) for r in got} == {(q, "d00", i, 7, k) for q in range(200) for k, i in ((2, 90), (3, 180))}
    # Each node's three words go through one shuffle; the rest is a few rows for each kind of node.
    assert n < 3 * 3000 + 500


def test_searches_of_many_words(spark):
    rnd = random.Random(13)
    words = [f"{a}{b}{c}" for a in "kl" for b in "aeiou" for c in "mnprst"] + ["ka", "lo", "x"]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, n)))
    nodes = [(f"d{i % 7}", i % 90, None if i % 11 == 0 else say(4).upper(), None if i % 9 == 0 else say(6)) for i in range(200)]
    asked = [(q, say(6)) for q in range(60)] + [(60, "KAM kam  lo x"), (60, "lit"), (61, None)]
    lists = {q: {w for p, t in asked if p == q and t for w in t.lower().split() if len(w) > 1} for q, _ in asked}
    want = set()
    for q, own in lists.items():
        n = Counter()
        for d, i, title, summary in nodes:
            n[d, i] += sum(3 * (w in (title or "").lower()) + (w in (summary or "")) for w in own)
        best = sorted((k for k in n if n[k]), key=lambda k: (-n[k], k))[2:6]
        want |= {(q, *k, n[k], r) for r, k in enumerate(best, 3)}
    got = docindex.search_nodes(spark.createDataFrame(nodes, "doc_id string, node_id int, title string, summary string"), spark.createDataFrame(asked, "query_id int, query string"), 4, 2)
    assert {(r.query_id, r.doc_id, r.node_id, r.score, r["rank"]) for r in got.collect()} == want and len(want) > 150
    assert len(set().union(*lists.values())) < grams.FEW
    old, grams.FEW = grams.FEW, 5
    try:
        assert {(r.query_id, r.doc_id, r.node_id, r.score, r["rank"]) for r in docindex.search_nodes(spark.createDataFrame(nodes, "doc_id string, node_id int, title string, summary string"), spark.createDataFrame(asked, "query_id int, query string"), 4, 2).collect()} == want
    finally:
        grams.FEW = old


def _plain_audit(values, attributes, old, entities):
    """The scans one after the other, value by value."""
    pairs = {}
    for plant, attribute, value, source in values:
        if plant in entities and attribute in attributes:
            pairs.setdefault((plant, attribute), []).append((value, source))
    known, out = {(p, a, v if v is not None else "null") for p, a, v in old}, {}
    for pair, said in pairs.items():
        named, (name, allowed) = [(v, s) for v, s in said if s is not None], attributes[pair[1]]
        bad = len({v for v, _ in named if v is not None}) > 1 and len({s for _, s in named}) > 1
        for v, s in said:
            low = v.strip(" ").lower() if v is not None else None
            scans = [1] * (bad and s is not None) + [2] * bool(allowed and low and low not in allowed) + [3] * (s is None)
            for scan in scans:
                note = {2: f'Value validation failure: "{v}" not in allowed set [{", ".join(allowed)}]', 3: evidence.MISSING_SOURCE}.get(scan)
                key = (*pair, v if v is not None else "null")
                found = (scan, s is not None, s or "", v is not None, v or "", name, note)
                out[key] = min(out.get(key, found), found)
    return {(p, a, name, v if known_v else "" if scan == 3 else None, s if named else None, scan, note) for (p, a, k), (scan, named, s, known_v, v, name, note) in out.items() if (p, a, k) not in known}


def _audit_tables(spark, rows=400):
    rnd = random.Random(17)
    values = [(rnd.randint(1, 14), rnd.randint(1, 5), rnd.choice(["a", "B ", "c", "null", None, "", " "]), rnd.choice(["S1", "S2", "S3", None])) for _ in range(rows)]
    lists = {1: ("one", ["a", "b"]), 2: ("two", []), 3: ("three", ["c"]), 4: ("four", [])}
    old = [(p, a, v) for p, a, v, _ in values[::9]] + [(99, 1, "a"), (1, 77, "c"), (2, 1, "none such")]
    attributes = spark.createDataFrame([(i, n, '[{"id":"%s"}]' % '"},{"displayName":"'.join(x) if x else None) for i, (n, x) in lists.items()], "id long, name string, values_allowed string")
    return values, lists, old, spark.createDataFrame(values, "plant_id long, attribute_id long, value string, source_id string"), attributes, spark.createDataFrame(old, "plant_id long, attribute_id long, value string")


def test_audit_reads_values_through_two_shuffles(spark):
    values, lists, old, v, attributes, existing = _audit_tables(spark)
    for known in (set(range(1, 15)), {1, 2, 3, 5, 8, 13}):
        entities = None if len(known) == 14 else spark.createDataFrame([(i,) for i in known], "id long")
        new = evidence.run_audit(v, attributes, existing, entities)
        got, n = shuffled(new)
        assert {(r.plant_id, r.attribute_id, r.attribute_name, r.value, r.source_id, r.scan, r.notes) for r in got} == _plain_audit(values, lists, old, known) and {r.scan for r in got} == {1, 2, 3}
        assert n < 2 * (len(values) + len(old)) + 20
        bad, n = shuffled(evidence.audit_results(new, evidence.audit_conflicts(new), v, entities, attributes))
        by = Counter(r.scan for r in got)
        assert (bad[0].validation_failures, bad[0].missing_provenance, bad[0].warrants_created) == (by[2], by[3], len(got))


def test_audit_conflicts_take_no_shuffle_of_their_own(spark):
    values, lists, old, v, attributes, existing = _audit_tables(spark)
    entities = spark.range(1, 15)
    new = evidence.run_audit(v, attributes, existing, entities)
    said, m = shuffled(new)
    got, n = shuffled(evidence.audit_conflicts(new))
    first = {}
    for r in said:
        if r.scan == 1:
            first.setdefault((r.plant_id, r.attribute_id), []).append((r.source_id, "null" if r.value is None else r.value, r.id, r.value))
    want = {(pair, x[0][2], x[1][2], x[0][3], x[1][3], x[0][0], x[1][0]) for pair, x in ((p, sorted(x, key=lambda y: y[:3])) for p, x in first.items()) if len(x) > 1}
    assert {((r.plant_id, r.attribute_id), r.warrant_id_a, r.warrant_id_b, r.value_a, r.value_b, r.source_a, r.source_b) for r in got} == want and len(want) > 10
    assert n <= m


def test_few_claims_meet_the_store_where_it_is(spark, tmp_path):
    store = spark.createDataFrame([(f"i{i}", i % 900, i % 2, f"v{i}") for i in range(3000)] + [(None, 1, 7, "x"), ("n", None, 1, "y")], "id string, plant_id long, attribute_id long, value string").repartition(3)
    claims = spark.createDataFrame([("a", 5, 1, "new", 1), ("b", 5, 1, "newer", 2), ("c", 5000, 1, "added", 1), ("d", 1, 7, "lost", 1), ("e", 7, 1, None, 1), ("f", None, 1, "none", 1)], "id string, plant_id long, attribute_id long, new_value string, approved_at int")
    store.write.parquet(str(tmp_path / "store"))
    got, n = shuffled(cl.upsert_values(spark.read.parquet(str(tmp_path / "store")), claims))
    said = {r.id: (r.value, r.action) for r in got}
    least = min(f"i{i}" for i in range(3000) if i % 900 == 5 and i % 2 == 1)
    assert len(got) == 3004 and said[least] == ("newer", "updated") and said["new-5000-1"] == ("added", "inserted") and said["new-1"] == ("none", "inserted")
    assert Counter(r.action for r in got) == {"kept": 3001, "updated": 1, "inserted": 2}
    assert n == 0


def test_snapshots_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    def never(self, *a, **b):
        raise AssertionError("rows were dealt out anew")

    df = spark.range(20_000).selectExpr("concat('k', id % 15000) AS k", "id AS v")
    bounds = cl.range_bounds(df, "k", 16, 2000)
    assert len(bounds) == 15 and all(400 < n < 3200 for n in Counter(sum(b <= r.k for b in bounds) for r in df.collect()).values())
    assert cl.range_bounds(df.filter("k = 'k7'"), "k", 4, 10) == ["k7"] and cl.range_bounds(df.filter("false"), "k", 4) == []
    monkeypatch.setattr(type(df), "repartition", never)
    cl.write_snapshot(df, str(tmp_path / "s"), ["k"], bounds)
    assert spark.read.parquet(str(tmp_path / "s/rows")).count() == 20_000


def test_sections_of_attributes_meet_conflicts_where_they_are(spark, tmp_path):
    tables = {
        "x": spark.createDataFrame([(f"c{i}", f"w{i % 40}", f"w{(i + 1) % 40}", None if i % 50 == 9 else f"fire {i % 3}") for i in range(600)], "id string, warrant_a_id string, warrant_b_id string, attribute_name string"),
        "w": spark.createDataFrame([(f"w{i}", f"{1900 + i}", f"S{i % 4}") for i in range(39)], "id string, source_year string, source_dataset string"),
        "docs": spark.createDataFrame([(f"S{i}", "d" * 4000, f"r{i}") for i in range(3)], "source_dataset string, dictionary string, readme string"),
        "nodes": spark.createDataFrame([("d", i, f"Fire {i}", "smoke 1") for i in range(9)], "doc_id string, node_id int, title string, summary string"),
        "attributes": spark.createDataFrame([(f"fire {i}",) for i in range(2)] + [("none",), (None,)], "name string"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    for attributes in (t["attributes"], None):
        got, n = shuffled(evidence.evidence_bundle(t["x"], t["w"], t["docs"], t["nodes"], 2, **({"attributes": attributes} if attributes else {})))
        assert len(got) == 600 and n < 600
        for r in got:
            i = int(r.id[1:])
            a, b = i % 40, (i + 1) % 40
            assert (r.source_year_a, r.source_year_b) == tuple(f"{1900 + k}" if k < 39 else None for k in (a, b)) and r.readme_a == (f"r{a % 4}" if a < 39 and a % 4 < 3 else None) and len(r.dictionary_b or "") in (0, 3000)
            # Two words of a name: the section that has both in its title comes first, then by number.
            want = None if r.attribute_name is None or (attributes and r.attribute_name == "fire 2") else [0, 1]
            assert want == (None if r.sections is None else [s.node_id for s in r.sections])
