"""Searches by index, trees, chunks, numbered rows, grids, snapshots and sinks against plain versions of the same."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corroborate.operators import claims as cl
from corroborate.operators import docindex, eav, evidence, grams, harvest, matching
from corroborate.sources import tables
from corroborate.streaming import sinks, streams


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def like(a, b):
    return 1 - edits(a, b) / max(len(a), len(b))


@pytest.mark.parametrize("k", [1, 3, 40])
def test_nearest_names_are_those_of_brute_force(spark, k):
    rnd = random.Random(k)
    word = lambda n: "".join(rnd.choice("abcde ") for _ in range(n)).strip() or "a"
    known = sorted({word(rnd.randint(1, 16)) for _ in range(60)} | {"aaaaaaaaaa", "aaaaaaaaab", "q" * 40})
    asked = sorted({word(rnd.randint(1, 18)) for _ in range(25)} | {"aaaaaaaaaa", "zzzzzzzz", "z", known[3] + "e", known[7][1:] or "b", "w" * 60})
    got: dict = {}
    rows = [(i, "g", str(i), t) for i, t in enumerate(known)]
    out = matching.nearest_names(spark.createDataFrame([(t, t) for t in asked], "name string, full string"), spark.createDataFrame(rows, "plant_id long, g string, s string, full string"), k)
    for r in out.collect():
        got.setdefault(r.name, []).append((r.r, r.plant_id, round(r.sim, 9)))
    for t in asked:
        best = sorted((-like(t, x), i) for i, x in enumerate(known))[:k]
        assert sorted(got[t]) == [(n, i, round(-s, 9)) for n, (s, i) in enumerate(best, 1)]


def test_nearest_names_of_no_names(spark):
    known = spark.createDataFrame([], "plant_id long, g string, s string, full string")
    assert matching.nearest_names(spark.createDataFrame([("a", "a")], "name string, full string"), known).count() == 0


def test_matches_by_parsed_name(spark):
    plants = spark.createDataFrame([(1, "Acer", "rubrum"), (2, "Rosa", "canina"), (3, "Abelia", None), (4, "Acer", "negundo")], "id long, genus string, species string")
    usda = spark.createDataFrame([("Acer carolinianum Walter", "ACRU", 1), ("Acer rubrum L.", "ACRU", 0), ("Cynorrhodon Gaertn.", "ROCA", 1), ("Rosa canina L.", "ROCA", 0)], "name_full string, symbol string, is_synonym int")
    names = ["Acer rubrum", "acer rubrum 'Red'", "Acer carolinianum 'Red'", "Acer x carolinianum", "Cynorrhodon", "Acer negundoo", "Acer", "Abelia 'Goucher'", "Quercus robur", "Rosa sp.", None, "  "]
    rows = spark.createDataFrame(list(enumerate(names)), "source_row int, name string")
    m = matching.match_entities(rows, plants, usda)
    got = {r.source_row: r for r in matching.match_rows(rows, m).collect()}
    kinds = ["EXACT", "EXACT", "SYNONYM", "SYNONYM", "NONE", "FUZZY", "GENUS_ONLY", "GENUS_ONLY", "NONE", "GENUS_ONLY", "NONE", "NONE"]
    assert [got[i].match_type for i in range(len(names))] == kinds
    assert got[2].plant_id == 1 and got[2].notes == "Synonym resolved via USDA_PLANTS: Acer carolinianum → Acer rubrum"
    assert got[5].plant_id == 4 and got[5].notes == "Fuzzy match: genus exact, species 88% similar" and [a.plant_id for a in got[5].alternatives] == [4, 1]
    assert got[6].plant_id is None and got[6].notes == "Genus-only match: 2 plants in genus Acer"
    assert got[7].plant_id == 3 and got[7].notes == "Cultivar 'Goucher' with genus-only match (1 plants in genus)"
    near = [(a.plant_id, round(a.similarity, 6)) for a in got[8].alternatives]
    full = {1: "acer rubrum", 2: "rosa canina", 3: "abelia", 4: "acer negundo"}
    assert near == sorted(((i, round(like("quercus robur", t), 6)) for i, t in full.items()), key=lambda x: (-x[1], x[0]))[:3]
    assert got[8].notes == f"No match found for Quercus robur (best fuzzy: Acer rubrum at {math.floor(100 * like('quercus robur', 'acer rubrum') + 0.5)}%)"
    assert matching.match_cultivar(m.filter("match_type not in ('EXACT', 'SYNONYM')").select("name"), plants).count() == 0


def test_substrings_are_those_of_contains(spark):
    rnd = random.Random(5)
    texts = [(i, "".join(rnd.choice("abć🙂.*+ \n") for _ in range(rnd.randint(0, 30)))) for i in range(150)] + [(900, None), (901, ""), (902, "a" * 5000)]
    words = sorted({"".join(rnd.choice("abć🙂.*+ ") for _ in range(rnd.randint(1, 5))) for _ in range(120)} | {"aaaaaaaaaa", "zzz", ".*", "🙂"})
    got = grams.containing(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame([(w,) for w in [*words, "", words[0]]], "word string"))
    assert sorted((r.id, r.word) for r in got.collect()) == sorted((i, w) for i, t in texts for w in words if t and w in t)


def test_searches_join_by_key(spark, capsys):
    nodes = spark.createDataFrame([("d", str(i), f"Fire {i}", "deer browse") for i in range(20)], "doc_id string, node_id string, title string, summary string")
    asked = spark.createDataFrame([(1, "fire DEER deer x"), (2, "nothing")], "query_id int, query string")
    for df in (docindex.search_nodes(nodes, asked), docindex.search_terms(nodes, asked)):
        df.explain()
        assert "NestedLoop" not in capsys.readouterr().out
    assert {(r.node_id, r.score) for r in docindex.search_nodes(nodes, asked, 20).collect()} == {(str(i), 4) for i in range(20)}


def test_listed_within_words_and_brackets(spark):
    names = spark.createDataFrame([("Acer rubrum",), ("Rosa canina",), ("Hedera helix",), ("",), (None,)], "name string")
    lists = spark.createDataFrame([("A", "weed (ACER RUBRUM)"), ("B", "x-Rosa canina L."), ("A", "Rosa caninae"), ("C", None)], "list string, text string")
    assert {r.name: r.listed_in for r in eav.listing_status(names, lists).collect()} == {"Acer rubrum": ["A"], "Rosa canina": ["A", "B"], "Hedera helix": [], "": [], None: []}


def test_lookup_by_the_strategy_of_the_dataset(spark):
    rows = [("garden", 2, "Abelia 'Edward Goucher'"), ("garden", 3, "Acer Rubrum"), ("garden", 4, "acer rubrum"), ("usda", 9, "Acer rubrum var. trilobum K. Koch"), ("usda", 5, "Acer rubrum L."), ("usda", 1, "Acer negundo L."), ("birds", 7, "ACER"), ("fire", 1, "Rosa canina"), ("fire", 2, "Rosa bona")]
    long = spark.createDataFrame([(*r, c, v) for r in rows for c, v in (("Height", str(r[1])), ("slug", " "), ("symbol", "X"), ("id", "3"))], "dataset string, source_row int, name string, column string, value string")
    kinds = spark.createDataFrame([("usda", "prefix"), ("birds", "genus"), ("fire", "synonymy")], "dataset string, strategy string")
    former = spark.createDataFrame([("rosa Vera", "Rosa canina"), ("Rosa bona", "Rosa canina")], "original_name string, taxon_name string")
    known = spark.createDataFrame([("HEIGHT", "a1", "Height")], "column string, attribute_id string, attribute_name string")
    asked = spark.createDataFrame([("Abelia 'Edward Goucher'",), ("acer RUBRUM",), (" Acer rub ",), ("Rosa vera",), ("Rosa bona",), ("",), (None,)], "name string")
    got = {(r.asked, r.dataset): (r.matched_name, r.value, r.confidence, r.attribute_id) for r in eav.lookup_sources(asked, long, kinds, former, known).collect()}
    assert got == {
        ("Abelia 'Edward Goucher'", "garden"): ("Abelia 'Edward Goucher'", "2", 1.0, "a1"), ("acer RUBRUM", "garden"): ("Acer Rubrum", "3", 1.0, "a1"), ("acer RUBRUM", "usda"): ("Acer rubrum L.", "5", 1.0, "a1"), ("acer RUBRUM", "birds"): ("ACER", "7", 0.8, "a1"),
        ("Acer rub", "usda"): ("Acer rubrum L.", "5", 1.0, "a1"), ("Acer rub", "birds"): ("ACER", "7", 0.8, "a1"), ("Rosa vera", "fire"): ("Rosa canina", "1", 0.9, "a1"), ("Rosa bona", "fire"): ("Rosa bona", "2", 1.0, "a1"),
    }


def test_rows_of_split_files_and_folders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k|v\n" + "".join(f"{i}|{'x' * (i % 50)}y\n" + "|\n" * (i % 9 == 0) for i in range(3000)))
    (tmp_path / "b.csv").write_text("k|v\n7|only\n")
    (tmp_path / "c.csv").write_text("k|v\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = tables.with_source_row(tables.read_delimited(spark, str(tmp_path), "|"))
        assert df.rdd.getNumPartitions() >= 1 and spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 5
        got = df.select("k", "v", F.regexp_extract("source_file", "([a-z]).csv", 1).alias("f"), "source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 3001
    by = {f: sorted((r.source_row, int(r.k)) for r in got if r.f == f) for f in "ab"}
    assert by["b"] == [(2, 7)] and [k for _, k in by["a"]] == list(range(3000)) and len({n for n, _ in by["a"]}) == 3000


def test_deep_trees_take_few_rounds(spark, monkeypatch):
    chain = spark.createDataFrame([(i, f"n{i}", i - 1 if i else None) for i in range(12)] + [(50, "lost", 99), (51, "below", 50)], "id int, name string, parent_attribute_id int")
    rounds = []
    monkeypatch.setattr(eav, "kept", lambda df, keep=eav.kept: rounds.append(1) or keep(df))
    got = {r.id: (r.root_name, r.path, r.level) for r in eav.attribute_paths(chain).collect()}
    assert got[11] == ("n0", " > ".join(f"n{i}" for i in range(12)), 12) and got[51] == ("lost", "lost > below", 2)
    assert len(rounds) == 1 + 4
    coded = eav.tree_codes(chain)
    assert sorted(r.id for r in eav.below(coded, coded.filter("id = 7").first().code).collect()) == [7, 8, 9, 10, 11]
    assert sorted(r.id for r in eav.subtree(chain, "n9").collect()) == [9, 10, 11]
    with pytest.raises(ValueError):
        eav.tree_codes(spark.createDataFrame([(1, "a", 2), (2, "b", 3), (3, "c", 2)], "id int, name string, parent_attribute_id int"))


def chunked(sizes, budget, overlap):
    total = sum(sizes)
    if total <= budget:
        return [(0, len(sizes) - 1, total)]
    even = math.ceil((total / math.ceil(total / budget) + budget) / 2)
    out, start, held = [], 0, 0
    for i, t in enumerate(sizes):
        if held + t > even:
            out.append((start, i - 1, held))
            start = max(i - overlap, 0)
            held = sum(sizes[start:i])
        held += t
    return [*out, (start, len(sizes) - 1, held)]


@pytest.mark.parametrize("overlap", [0, 1, 3])
def test_chunks_are_those_of_the_walk(spark, overlap):
    rnd = random.Random(overlap)
    docs = {f"d{n}": [rnd.choice([0, 1, 3, 9, 30]) for _ in range(rnd.randint(1, 60))] for n in range(12)} | {"big": [100, 1, 1, 100, 100], "zero": [0, 0, 0], "long": [5] * 700}
    rows = [(d, 10 + i, "x" * (4 * t)) for d, sizes in docs.items() for i, t in enumerate(sizes)]
    got: dict = {}
    for r in docindex.chunk_pages(spark.createDataFrame(rows, "doc_id string, page int, text string").repartition(5), 40, overlap).collect():
        got.setdefault(r.doc_id, []).append((r.chunk, r.first_page, r.last_page, r.tokens))
    for d, sizes in docs.items():
        want = [(n, 10 + a if a <= z else None, 10 + z if a <= z else None, held) for n, (a, z, held) in enumerate(chunked(sizes, 40, overlap))]
        assert sorted(got[d]) == want, d


def test_nested_and_spanning_tables(spark):
    page = """<TABLE ID=plantsList><tr><th rowspan=2>A<th colspan=2>B<tr><td>1<td>2</tr><tr><td>x <a href="https://h/plants/acer-rubrum">link</a><table><tr><td>in<td rowspan="0">ner</table> y<td colspan="x">z</table>stray<td>no</td>
    <table><tr><td rowspan=3>r</td><td>1</td></tr><tr><td>2</td></tr></table><table><tr>"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    got = sorted((r.table_no, r.row_no, r.cells, r.is_header, r.table_id) for r in harvest.html_tables(df).collect())
    assert got == [(0, 0, ["A", "B", "B"], True, "plantsList"), (0, 1, ["A", "1", "2"], False, "plantsList"), (0, 2, ["x link y", "z"], False, "plantsList"), (1, 0, ["in", "ner"], False, None), (2, 0, ["r", "1"], False, None), (2, 1, ["r", "2"], False, None)]
    gaps = """<table><tr><td>a</td><td rowspan=3>b</td><td rowspan=2>c</td></tr><tr></tr><tr><td>d</td></tr><tr><td>e</td></tr></table>"""
    rows = harvest.html_tables(spark.createDataFrame([(1, gaps)], "page_id int, html string")).orderBy("row_no").collect()
    assert [r.cells for r in rows] == [["a", "b", "c"], ["d", "b"], ["e"]]
    one = harvest.html_tables(df, table_id="plantsList").select("row_no", harvest.table_slug("link").alias("slug")).collect()
    assert {(r.row_no, r.slug) for r in one} == {(0, None), (1, None), (2, "acer-rubrum")}


def test_a_replayed_batch_counts_once(spark, tmp_path):
    write = sinks.once_per_batch(str(tmp_path / "out"))
    df = spark.createDataFrame([(1,), (2,)], "x int")
    for n, part in ((0, df), (1, df.filter("x = 2")), (1, df.filter("x = 2")), (0, df)):
        write(part, n)
    assert sorted((r.x, r.batch_id) for r in sinks.batches(spark, str(tmp_path / "out"), df.schema).collect()) == [(1, 0), (2, 0), (2, 1)]
    assert [r.x for r in sinks.latest(spark, str(tmp_path / "out"), df.schema).collect()] == [2]


def test_a_stream_that_starts_again_writes_no_row_twice(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    sink, failed = sinks.once_per_batch(str(out)), []

    def write(df, n):
        sink(df, n)
        if n == 1 and not failed:
            failed.append(n)
            raise RuntimeError("lost after the write")

    def go():
        q = spark.readStream.schema("k int, t timestamp").parquet(str(src)).writeStream.foreachBatch(write).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
        q.awaitTermination()

    for n in range(2):
        spark.sql(f"SELECT {n} AS k, timestamp'2026-01-01' AS t").write.mode("append").parquet(str(src))
        if n == 0:
            go()
    with pytest.raises(Exception, match="lost after the write"):
        go()
    go()
    assert failed and sorted(r.k for r in sinks.batches(spark, str(out), spark.read.parquet(str(src)).schema).collect()) == [0, 1]


def test_sliding_windows_in_append_mode(spark, tmp_path):
    rows = [(f"2026-01-0{d} 12:00:00", s) for d, s in ((1, "a"), (1, "b"), (2, "a"), (3, "a"), (6, "a"))]
    spark.createDataFrame(rows, "t string, source_id string").select(F.col("t").cast("timestamp").alias("created_at"), "source_id").write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("created_at timestamp, source_id string").parquet(str(tmp_path / "in"))
    out = streams.stream_evidence_counts(src, "2 days", "1 day")
    q = out.writeStream.foreachBatch(sinks.once_per_batch(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "s")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.window_start.isoformat()[5:10], r.source, r.n) for r in sinks.batches(spark, str(tmp_path / "out"), out.schema).collect())
    # The watermark stands at noon of the fifth: windows that end after it are still open.
    assert got == [("01-01", "a", 2), ("01-01", "b", 1), ("01-02", "a", 2), ("01-03", "a", 1), ("12-31", "a", 1), ("12-31", "b", 1)]


def test_only_ranges_that_differ_are_read(spark, tmp_path):
    old = spark.range(4000).selectExpr("id AS k", "id % 7 AS v", "concat('t', id) AS text")
    new = old.withColumn("v", F.when(F.col("k") == 1234, 99).otherwise(F.col("v"))).filter("k <> 1250").withColumn("more", F.when(F.col("k") == 1240, "x"))
    bounds = cl.range_bounds(old, "k", 10)
    assert len(bounds) == 9
    for df, n in ((old, "old"), (new, "new")):
        cl.write_snapshot(df, str(tmp_path / n), ["k"], bounds)
    d = cl.stored_diff(spark, str(tmp_path / "old"), str(tmp_path / "new"), ["k"])
    want = cl.snapshot_diff(old, new, ["k"])
    assert sorted((r.k, r.change) for r in d.collect()) == sorted((r.k, r.change) for r in want.collect()) == [(1234, "modified"), (1240, "modified"), (1250, "removed")]
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "__range__" in plan
    read = {f for f in spark.read.parquet(str(tmp_path / "old/rows")).inputFiles()}
    some = {f for f in spark.read.parquet(str(tmp_path / "old/rows")).filter(F.col("__range__").isin([r["range"] for r in spark.read.parquet(str(tmp_path / "old/digests")).filter("range = 3").collect()])).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(some) < len(read) / 5
    same = cl.stored_diff(spark, str(tmp_path / "old"), str(tmp_path / "old"), ["k"])
    assert same.count() == 0


def test_diff_of_null_keys_and_new_columns(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "a", None), (1, "b", 5), (2, "c", None)], "k int, v string, extra int")
    assert sorted(((r.k or 0), r.change) for r in cl.snapshot_diff(old, new, ["k"]).collect()) == [(1, "modified"), (2, "added")]


def test_conflicts_that_lack_either_warrant(spark):
    w = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "id string, plant_id int, attribute_id int")
    c = spark.createDataFrame([("a", "b", "X"), ("a", "z", "X"), ("y", "b", "Y"), ("y", "z", None)], "id_a string, id_b string, conflict_type string")
    got = {r["check"]: r.n for r in cl.verify_run(w, c).collect()}
    assert got["orphan_conflicts"] == 3 and got["conflict_type_X"] == 2 and got["conflict_type_null"] == 1


def test_audit_of_known_groups_and_its_notes(spark):
    v = spark.createDataFrame([(1, 1, "Low", "s1"), (1, 1, "High", "s2"), (9, 1, "Low", "s1"), (9, 1, "High", "s2"), (1, 8, "x", "s1"), (1, 8, "y", "s2")], "plant_id int, attribute_id int, value string, source_id string")
    attrs = spark.createDataFrame([(1, "Fire", '[{"id":"a","displayName":" Low"},{"id":"Mid"}]')], "id int, name string, values_allowed string")
    plants = spark.createDataFrame([(1,)], "id int")
    none = v.filter("false")
    new = evidence.run_audit(v.filter("value <> 'Low' or plant_id = 1"), attrs, none, plants)
    first = evidence.audit_results(evidence.run_audit(v, attrs, none, plants), none.select(F.lit(1).alias("id")), v, plants, attrs).first()
    assert first.disagreements_found == 1
    only = evidence.run_audit(spark.createDataFrame([(1, 1, "High", "s2")], v.schema), attrs, none, plants).collect()
    assert [r.notes for r in only] == ['Value validation failure: "High" not in allowed set [low, mid]'] and new.count() == 2
