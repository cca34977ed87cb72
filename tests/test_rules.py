"""Literal inputs and outputs of rules that the reference fixes, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corroborate.functions import names
from corroborate.operators import claims, docindex, eav, evidence, harvest, matching, reports

RELIABILITY = "methodology_type string, peer_reviewed boolean, sample_size string, geographic_specificity string, temporal_currency string"


@pytest.mark.parametrize(("row", "want"), [
    (("experimental", True, "1,200", "local", "current"), 0.97), (("meta_analysis", True, "5000+", "local", "current"), 1.0), (("expert_opinion", False, "12", "global", "dated"), 0.36),
    (("literature_review", True, "100", "regional", "recent"), 0.75), (("modeling", False, "1000", "national", None), 0.49), (("modeled", False, "unknown", "planet", ""), 0.46),
    (("Experimental", None, None, None, None), 0.46),
])
def test_auto_score(spark, row, want):
    assert claims.auto_score(spark.createDataFrame([row], RELIABILITY)).first().auto_score == want


def test_inference(spark):
    rows = [("Meta-Analysis of lab work", "USDA zones", "2021"), ("Laboratory burn", "International", "2020 ed."), ("Observations", "Oregon", "2011"), ("compilation of surveys", "Oregon, Washington", "2010"), ("simulation", "Pacific Northwest", "x"), ("homeowner guide", "Mars", ""), ("hearsay", "", None), (None, None, None)]
    df = spark.createDataFrame(rows, "m string, r string, y string")
    got = [tuple(r) for r in df.select(names.infer_methodology("m"), names.infer_specificity("r"), names.infer_currency("y", 2026)).collect()]
    assert got == [("meta_analysis", "national", "current"), ("experimental", "national", "recent"), ("field_observation", "local", "recent"), ("field_observation", "regional", "dated"), ("modeling", "regional", None), ("expert_opinion", "regional", None), (None, None, None), (None, None, None)]


def test_categories(spark):
    want = {"Flammability": "fire", "Irrigation": "water", "Browse": "deer", "Place of origin": "native", "Invasive native": "native", "Invasiveness": "invasive", "Lepidoptera": "wildlife", "Height": "other"}
    got = spark.createDataFrame([(k,) for k in want], "a string").select("a", names.attribute_category("a").alias("c")).collect()
    assert {r.a: r.c for r in got} == want


def test_conflict_chain(spark):
    p = spark.createDataFrame([("1", "2", "REVIEW"), ("1", "3", "REVIEW"), ("1", "4", "COMPLETENESS_CONFLICT"), ("1", "5", "corroborated"), ("1", "6", "REVIEW"), ("1", "7", "REVIEW")], "id_a string, id_b string, verdict string")
    labels = spark.createDataFrame([("1", "2", "SCALE_MISMATCH", None), ("1", "3", "nonsense", "huge"), ("1", "4", "SCALE_MISMATCH", "critical"), ("1", "6", "TEMPORAL_CONFLICT", "critical")], "id_a string, id_b string, label string, label_severity string")
    got = {r.id_b: (r.conflict_type, r.severity, r.specialist_agent) for r in evidence.finalize_conflicts(p, labels).collect()}
    assert got == {"2": ("SCALE_MISMATCH", "moderate", "ratingConflictFlow"), "3": ("RATING_DISAGREEMENT", "critical", "ratingConflictFlow"), "4": ("COMPLETENESS_CONFLICT", "minor", None), "6": ("TEMPORAL_CONFLICT", "critical", "temporalConflictFlow"), "7": ("RATING_DISAGREEMENT", "moderate", "ratingConflictFlow")}


def test_queue_and_matrix(spark):
    rows = [(1, "annotated", "minor"), (1, "annotated", "critical"), (2, "annotated", "minor"), (2, "dismissed", "moderate"), (3, "resolved", "odd"), (3, "dismissed", "minor"), (4, "pending", "minor")]
    x = spark.createDataFrame([(p, s, v, f"a{i}", "S1", "S2") for i, (p, s, v) in enumerate(rows)], "plant_id long, status string, severity string, attribute_name string, source_a string, source_b string")
    assert [(r.plant_id, r.max_severity, r.n_open, r.queue_status) for r in reports.conflict_queue(x).collect()] == [(1, "critical", 2, "pending"), (2, "moderate", 1, "in_progress"), (4, "minor", 1, "pending"), (3, "minor", 0, "complete")]
    m = reports.conflict_matrix(x).first()
    assert (m.n, m.n_pending, m.n_resolved) == (7, 1, 3) and reports.source_conflict_summary(x).filter("source = 'S2'").first().resolution_rate == 42.9


def test_batch_notes(spark):
    df = spark.createDataFrame([("1", '{"currentStep": "mapping", "steps": {"matching": {"status": "complete", "detail": "9 rows"}}}'), ("2", "plain"), ("3", None)], "id string, notes string")
    got = {(r.id, r.step): (r.current_step, r.state, r.detail) for r in reports.batch_progress(df).collect()}
    assert got["1", "matching"] == ("mapping", "complete", "9 rows") and got["1", "mapping"] == ("mapping", "pending", None) and got["2", "matching"] == got["3", "committing"] == ("pending", "pending", None)


def test_audit(spark):
    v = spark.createDataFrame([(1, 1, "a", "S2"), (1, 1, "b", "S1"), (1, 1, "c", None), (2, 1, "a", None), (2, 1, "b", "S1"), (3, 1, "a", "S1"), (3, 1, "a", "S2"), (4, 9, "z", None), (5, 1, None, None)], "plant_id long, attribute_id long, value string, source_id string")
    a = spark.createDataFrame([(1, "one", '[{"displayName":"A"},{"id":"B"}]')], "id long, name string, values_allowed string")
    old = spark.createDataFrame([(2, 1, "a")], "plant_id long, attribute_id long, value string")
    new = evidence.run_audit(v, a, old)
    assert sorted((r.plant_id, r.value, r.scan) for r in new.collect()) == [(1, "a", 1), (1, "b", 1), (1, "c", 2), (5, "", 3)]
    x = evidence.audit_conflicts(new)
    assert [(r.plant_id, r.value_a, r.value_b, r.source_a, r.source_b, r.severity) for r in x.collect()] == [(1, "b", "a", "S1", "S2", "moderate")]
    assert evidence.audit_results(new, x, v).first().asDict() == {"validation_failures": 1, "missing_provenance": 1, "warrants_created": 4, "disagreements_found": 1, "conflicts_created": 1}


def test_resolution_order(spark):
    rows = [("a", "critical", "cross_source"), ("b", "minor", "internal"), ("c", "moderate", "external"), ("d", "moderate", "internal"), ("e", "critical", "external"), ("f", "critical", "internal")]
    got = evidence.resolution_queue(spark.createDataFrame(rows, "id string, severity string, conflict_mode string")).collect()
    assert [r.id for r in got] == ["f", "e", "d", "c", "b", "a"]


def test_swapped_nulls_are_a_change(spark):
    old = spark.createDataFrame([(1, "x", None), (2, None, None)], "id long, a string, b string")
    new = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id long, a string, b string")
    d = claims.snapshot_diff(old, new, ["id"])
    assert [(r.id, r.change, r.old.a, r.new.b) for r in d.collect()] == [(1, "modified", "x", "x")]
    assert sorted((r.id, r.a, r.b, r.conflict) for r in claims.revert(new, d, ["id"]).collect()) == [(1, "x", None, False), (2, None, None, False)]
    later = spark.createDataFrame([(1, "y", "y"), (2, None, None)], "id long, a string, b string")
    assert sorted((r.id, r.a, r.conflict) for r in claims.revert(later, d, ["id"]).collect()) == [(1, "y", True), (2, None, False)]
    log = spark.createDataFrame([(f"s{i}", f"2024-01-0{i}") for i in range(1, 8)], "snapshot_id string, committed_at string")
    assert claims.revert(new, d, ["id"], log, "s3").count() == 2
    with pytest.raises(ValueError):
        claims.revert(new, d, ["id"], log, "s2")


def test_triage(spark):
    rows = [("Smith, J.", "Fire & Press", "1999", "", "x", None, "Yes"), ("Smith, J.", "Garden fire", "1999", None, "", None, None), ("", "A", "n.d.", "", "timber press", None, "No"), ("", "", "", "", "", "dataset", None), (None, "Q", None, None, None, None, None)]
    r = harvest.triage_refs(spark.createDataFrame(rows, "author string, title string, year string, publisher string, description string, type string, have_it string")).collect()
    assert [x.triage for x in r] == ["HAVE_IT", "LIKELY_ONLINE", "CHECK_LIBRARIES", "HAVE_IT", "TRY_ONLINE"]
    assert r[0].google_scholar_url == "" and r[1].google_scholar_url == "https://scholar.google.com/scholar?q=Smith+Garden+fire+1999" and r[1].google_search_url.endswith("1999+filetype%3Apdf")
    assert r[1].wayback_url == "https://web.archive.org/web/*/Garden+fire" and r[3].worldcat_url == ""


def test_traits(spark):
    t = "Height: 2–4.5 feet\nheight: 6 Inches\nUSDA hardiness zones: 5-9\nFlowers: small, white\nBloom time: May\nL means low water\nNative, western parts; invasive"
    r = harvest.extract_traits(spark.createDataFrame([(1, t), (2, None)], "k long, t string"), "k", "t").orderBy("k").collect()
    assert (r[0].heights, r[0].spreads, r[0].zones, r[0].flowers, r[0].blooms, r[0].water_use, r[0].invasive_warning, r[0].native_hint) == (["2–4.5 feet", "6 Inches"], [], ["5-9"], ["small, white"], ["May"], "Low", True, True)
    assert (r[1].heights, r[1].water_use, r[1].native_hint) == ([], "", False)


def test_species_record(spark):
    j = '{"scientific_name":"Acer Rubrum","edible":false,"flower":{"color":["Dark Red","violet-blue"]},"foliage":{"leaf_retention":false},"specifications":{"growth_habit":["Tree","Subshrub"]},"distribution":{"native":["N. California","Texas"]}}'
    e = spark.createDataFrame([(7, "acer", "rubrum")], "id long, genus string, species string")
    got = sorted((r.attribute, r.value, r.source_value) for r in harvest.species_to_warrants(spark.createDataFrame([(j,), ("broken",), (None,)], "json string"), e).collect())
    assert got == [("Edible Plant", "false", "edible: false"), ("Flower Color", "04", "flower.color: Dark Red, violet-blue"), ("Flower Color", "05", "flower.color: Dark Red, violet-blue"), ("Flower Color", "06", "flower.color: Dark Red, violet-blue"), ("Groundcover", "true", "growth_habit: Tree, Subshrub"), ("Native Status", "california", "Native to: N. California, Texas"), ("Tree", "true", "growth_habit: Tree, Subshrub")]


def test_even_chunks(spark):
    p = spark.createDataFrame([("a", i, "x" * 40) for i in range(1, 8)] + [("b", 1, "x" * 40)], "doc_id string, page long, text string")
    # 70 tokens in 3 parts of 30 at most: a part ends before 27 are passed.
    assert [(r.first_page, r.last_page, r.tokens) for r in docindex.chunk_pages(p, 30, 1).filter("doc_id = 'a'").orderBy("chunk").collect()] == [(1, 2, 20), (2, 3, 20), (3, 4, 20), (4, 5, 20), (5, 6, 20), (6, 7, 20)]
    assert [(r.first_page, r.last_page, r.tokens) for r in docindex.chunk_pages(p, 30, 1).filter("doc_id = 'b'").collect()] == [(1, 1, 10)]


def test_misspelt_genus(spark):
    e = spark.createDataFrame([(1, "Acer", "rubrum"), (2, "Rosa", "canina"), (3, "Acer", None)], "id long, genus string, species string")
    asked = ["Acerr rubrum", "Acer rubrux", "Roza caninna", "Unknown thing", "Rosae", "acerrubrum", "Acer negundo"]
    got = {r.name: (r.match_type, r.plant_id, round(r.confidence, 3)) for r in matching.match_entities(spark.createDataFrame([(n,) for n in asked], "name string"), e).collect()}
    assert got == {"Acerr rubrum": ("FUZZY", 1, 0.825), "Acer rubrux": ("NONE", None, 0.0), "Roza caninna": ("NONE", None, 0.0), "Unknown thing": ("NONE", None, 0.0), "Rosae": ("NONE", None, 0.0), "acerrubrum": ("FUZZY", 1, 0.818), "Acer negundo": ("NONE", None, 0.0)}


def test_near_names_lose_none(spark):
    import random

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, was = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(was[j] + 1, row[-1] + 1, was[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    known = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 24))) for _ in range(60)]
    asked = known[:20] + ["".join(c for c in rng.choice(known) if rng.random() > 0.06) + rng.choice(["", "a", "bc"]) for _ in range(80)]
    k = spark.createDataFrame([(i, t) for i, t in enumerate(known)], "plant_id long, full string").selectExpr("plant_id", "full AS g", "'' AS s", "full")
    n = spark.createDataFrame([(str(i), t) for i, t in enumerate(asked)], "name string, full string")
    got = {(r.name, r.plant_id) for r in matching.near_names(n, k, 0.85).collect()}
    assert got == {(str(i), j) for i, a in enumerate(asked) for j, b in enumerate(known) if a and 1 - lev(a, b) / max(len(a), len(b)) >= 0.85 - 1e-12}


def test_tree_of_any_depth(spark):
    deep = spark.createDataFrame([(str(i), f"n{i}", str(i - 1) if i else None) for i in range(12)] + [("x", "lost", "nowhere")], "id string, name string, parent_attribute_id string")
    got = {r.id: (r.root_name, r.level) for r in eav.attribute_paths(deep).collect()}
    assert got["11"] == ("n0", 12) and got["x"] == ("lost", 1) and eav.subtree(deep, "n0").count() == 12
    with pytest.raises(ValueError):
        eav.attribute_paths(spark.createDataFrame([("a", "a", "b"), ("b", "b", "a")], "id string, name string, parent_attribute_id string"))


def test_coverage_order_and_skips(spark):
    a = spark.createDataFrame([("r", "Fire", None), ("x", "b", "r"), ("y", "a", "r"), ("b1000001-7", "calc", "r"), ("z", "z", "gone")], "id string, name string, parent_attribute_id string")
    v = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 1)], "attribute_id string, plant_id long").withColumn("value", F.lit(None).cast("string"))
    e = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    rows = lambda **k: [(r.attribute_id, r.category, r.n_entities, r.pct) for r in eav.attribute_coverage(e, a, v, **k).collect()]
    assert rows() == [("z", "Uncategorized", 0, 0.0), ("y", "Fire", 1, 33.3), ("x", "Fire", 2, 66.7)]
    assert [r[0] for r in rows(sort="name", category="fire")] == ["y", "x"] and [r[0] for r in rows(sort="coverage_desc", calculated=("x",))] == ["y", "z"]
