"""Small fixtures for operators without SQL and for rules that need care."""

import os

import pytest
from pyspark.sql import functions as F

from corroborate.functions import names
from corroborate.operators import claims, docindex, eav, evidence, harvest, matching, reports
from corroborate.sources import tables
from corroborate.streaming import streams


@pytest.mark.parametrize(("name", "want"), [
    ("Acer rubrum", ("Acer", "rubrum", None, False)), ("Acer rubrum 'Red Sunset'", ("Acer", "rubrum", "Red Sunset", False)),
    ("Abelia x grandiflora", ("Abelia", "grandiflora", None, False)), ("Abelia × grandiflora", ("Abelia", "grandiflora", None, False)),
    ("Quercus spp.", ("Quercus", None, None, True)), ("Musa sp", ("Musa", None, None, True)), ("Cornus x 'Rutban'", ("Cornus", None, "Rutban", True)),
    ("Acer Rubrum", ("Acer", None, None, True)), ("", (None, None, None, False)), ("Rosa canina x", ("Rosa", "canina", None, False)), ("Rosa X alba", ("Rosa", None, None, True)), ("Acer var. rubrum", ("Acer", None, None, True)), ("  Acer R.rubrum ", ("Acer", "R.rubrum", None, False)),
])
def test_parse_name(spark, name, want):
    got = spark.createDataFrame([(name,)], "n string").select(names.parse_name("n").alias("p")).select("p.*").first()
    assert tuple(got) == want


def test_scalars(spark):
    r = spark.range(1).select(
        names.similarity(F.lit("rubrum"), F.lit("rubrun")).alias("sim"), names.similarity(F.lit(""), F.lit(None)).alias("empty"), names.is_nullish(F.lit(" N/A ")).alias("nul"),
        names.extract_json(F.lit('So:\n```json\n{"a": 1}\n```')).alias("j"), names.extract_json(F.lit("none")).alias("nj"), names.parse_range(F.lit("2-4 ft"))["high"].alias("hi"), names.strip_author(F.lit("Rosa canina L.")).alias("s"),
    ).first()
    assert (round(r.sim, 3), r.empty, r.nul, r.j, r.nj, r.hi, r.s) == (0.833, 1.0, True, '{"a": 1}', None, 4.0, "Rosa canina")


def test_pair_counts(spark):
    rows = [(1, g, f"{g}-{i}", "abcdefghi"[i % 2 + (i > 6)], f"S{i}", "unreviewed", "existing") for g, n in ((1, 1), (2, 2), (5, 5), (6, 6), (9, 9)) for i in range(n)]
    w = spark.createDataFrame(rows, "plant_id long, attribute_id long, id string, value string, source_id string, status string, warrant_type string")
    got = {r.attribute_id: r["count"] for r in evidence.conflict_pairs(evidence.warrant_group_members(w)).groupBy("attribute_id").count().collect()}
    assert got == {2: 1, 5: 10, 6: 5, 9: 8}


def test_pairs_of_a_hot_group_with_repeats_and_nulls(spark):
    rows = [(1, 1, f"w{i}", None if i % 4 == 0 else "b", None if i % 5 == 0 else f"S{i % 3}") for i in range(40)]
    rows += [r for r in rows if r[2] == "w5"] + [(2, 1, "x", "a", "S1")] * 3
    got = sorted(((r.plant_id, r.id_a, r.id_b) for r in evidence.conflict_pairs(spark.createDataFrame(rows, "plant_id long, attribute_id long, id string, value string, source_id string")).collect()))
    # The mode is b; its first row by source (nulls first) and id is w15 or another row without a source.
    first = min((r for r in rows if r[0] == 1 and r[3] == "b"), key=lambda r: (r[4] is not None, r[4] or "", r[2]))
    rest = [r[2] for r in rows if r[0] == 1]
    rest.remove(first[2])
    assert got == sorted([(1, first[2], x) for x in rest] + [(2, "x", "x")] * 3)


def test_list_items_are_trimmed_of_spaces_only(spark):
    df = spark.createDataFrame([("a0; 1b", "10; 01")], "bad string, good string")
    assert sorted((r.bad, r.good) for r in eav.swap_pairs(df).collect()) == [("1b", "01"), ("1b", "10"), ("a0", "01"), ("a0", "10")]


def test_nullish_pairs(spark):
    p = spark.createDataFrame([("High", "high "), (None, "x"), ("unknown", "n/a"), ("a", "b")], "value_a string, value_b string")
    assert [r.verdict for r in evidence.classify_pairs(p).collect()] == ["corroborated", "COMPLETENESS_CONFLICT", "REVIEW", "REVIEW"]


def test_synonyms_and_genus(spark):
    b = spark.createDataFrame([("Acer rubrum L.", "ACRU", 0), ("Acer carolinianum Walter", "ACRU", 1)], "name_full string, symbol string, is_synonym int")
    n = spark.createDataFrame([("Acer carolinianum",), ("Acer rubrum",), ("Nope nope",)], "name string")
    got = {r.name: (r.accepted, r.confidence) for r in matching.resolve_name(n, [("USDA", b)]).collect()}
    assert got == {"Acer carolinianum": ("Acer rubrum L.", 0.95), "Acer rubrum": ("Acer rubrum L.", 1.0), "Nope nope": (None, 0.0)}
    e = spark.createDataFrame([(1, "Acer", "rubrum"), (2, "Acer", "negundo"), (3, "Rosa", "canina")], "id long, genus string, species string")
    m = matching.match_entities(spark.createDataFrame([("Acer carolinianum",), ("Acer spp.",), ("Rosa spp.",), ("Acer rubrun",)], "name string"), e, b)
    assert {r.name: (r.match_type, r.plant_id) for r in m.collect()} == {"Acer carolinianum": ("SYNONYM", 1), "Acer spp.": ("GENUS_ONLY", None), "Rosa spp.": ("GENUS_ONLY", 3), "Acer rubrun": ("NONE", None)}
    assert matching.expand_genus(m, e).filter("name = 'Acer spp.'").count() == 2


def test_mapping(spark):
    rows = spark.createDataFrame([(2, "Hi", "", "z"), (3, "HI", "q", "z")], "source_row long, rating string, other string, skip string")
    m = spark.createDataFrame([("rating", "MAP", "A1", {"Hi": "high"}), ("other", "MAP", "A2", {"x": "y"}), ("skip", "SKIP", "A3", None)], "source_column string, mapping_type string, target_attribute_id string, crosswalk map<string,string>")
    got = {(r.source_row, r.source_column): (r.value, r.missed) for r in evidence.apply_mapping(rows, m).collect()}
    assert got == {(2, "rating"): ("high", False), (3, "rating"): ("high", False), (3, "other"): ("q", True)}


def test_score_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "methodology_type string, peer_reviewed boolean, sample_size string, geographic_specificity string, temporal_currency string")
    assert claims.auto_score(df).first().auto_score == 0.46


def test_diff_of_equal_snapshots_is_empty(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id long, value string")
    b = spark.createDataFrame([(1, "y"), (2, None), (3, "z")], "id long, value string")
    assert claims.snapshot_diff(a, a, ["id"]).count() == 0
    d = claims.snapshot_diff(a, b, ["id"])
    assert {r.id: r.change for r in d.collect()} == {1: "modified", 3: "added"}
    assert {r.id: r.value for r in claims.revert(b, d, ["id"]).collect()} == {1: "x", 2: None}


def test_csv(spark, tmp_path):
    (tmp_path / "plants.csv").write_text('﻿name,note\r\n"Acer, red","a ""b""\nc"\r\n,\r\nRosa\r\n', encoding="utf-8")
    got = [tuple(r) for r in tables.read_source_csv(spark, str(tmp_path / "plants.csv")).collect()]
    assert got == [("Acer, red", 'a "b"\nc'), ("Rosa", "")]
    assert [p.rsplit("/", 1)[1] for p in tables.pick_source_files(spark, str(tmp_path))] == ["plants.csv"]


def test_dump(spark, tmp_path):
    (tmp_path / "d.sql").write_text("x\nCOPY public.plants (id, name) FROM stdin;\n1\tAcer\n2\t\\N\n\\.\n")
    got = [(r.table, r.columns, r.cells) for r in tables.tables_from_sql_dump(spark, str(tmp_path / "d.sql")).collect()]
    assert got == [("plants", ["id", "name"], ["1", "Acer"]), ("plants", ["id", "name"], ["2", ""])]


def test_dump_over_several_splits(spark, tmp_path):
    blocks = "".join(f"-- {t}\nCOPY public.{t} (id) FROM stdin;\n" + "".join(f"{t}{i}\n" for i in range(400)) + "\\.\n\nSET x = 1;\n" for t in ("a", "b", "c"))
    (tmp_path / "d.sql").write_text(blocks)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        out = tables.tables_from_sql_dump(spark, str(tmp_path / "d.sql"))
        got = sorted((r.table, r.cells[0]) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((t, f"{t}{i}") for t in "abc" for i in range(400))


def test_dataset_papers(spark, tmp_path):
    for name, text in (("A", "Source: FIRE-07, 1,234 plants"), ("B", "nothing")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "README.md").write_text(text)
        (tmp_path / name / "notes.md").write_text("DEER-99")
    (tmp_path / "B" / "DATA-DICTIONARY.md").write_text("DEER-02")
    papers = tables.read_dataset_papers(spark, str(tmp_path))
    counts = spark.createDataFrame([("A", 5), ("B", 6)], "dataset string, n_rows long")
    assert sorted((r.dataset, r.source_id, r.category, r.n_records) for r in tables.dataset_registry(papers, counts).collect()) == [("A", "FIRE-07", "FIRE", 1234), ("B", "DEER-02", "DEER", 6)]


def test_streams_drop_late_rows(spark, tmp_path):
    """What comes after the watermark is left out: two batches move it (it counts a batch later), a third one is late."""
    schema = "user_id long, event_type string, ts timestamp"
    rows = [[(1, "a", "2024-01-10 00:00:00"), (1, "a", "2024-01-10 00:10:00"), (2, "b", "2024-01-20 00:00:00")], [(2, "b", "2024-01-20 00:20:00")], [(1, "late", "2024-01-01 00:00:00")], [(3, "c", "2024-02-20 00:00:00")]]
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "user_id long, event_type string, t string").selectExpr("user_id", "event_type", "CAST(t AS TIMESTAMP) AS ts").coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        (file,) = (tmp_path / f"part{i}").glob("*.parquet")
        file.rename(tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streams.stream_sessions(src).writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.user_id, r.n) for r in spark.table("sessions").collect()) == [(1, 2), (2, 2)]


def test_html(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>N</th></tr><tr><td>a <b>b</b></td><td>c</td></tr></table>"), (2, None)], "page_id long, html string")
    got = [(r.row_no, r.cells, r.is_header) for r in harvest.html_tables(pages).orderBy("row_no").collect()]
    assert got == [(0, ["N"], True), (1, ["a b", "c"], False)]


def test_documents(spark):
    d = spark.createDataFrame([("a", '[{"title":"T","node_id":"1","start_index":1,"end_index":9,"nodes":[{"title":"U","node_id":"2"}]}]'), ("b", "broken")], "doc_name string, structure string")
    assert [(r.node_id, r.parent_id, r.depth) for r in docindex.flatten_nodes(d).orderBy("depth").collect()] == [("1", None, 0), ("2", "1", 1)]
    pages = spark.createDataFrame([("a", i, "x" * 40) for i in range(1, 6)], "doc_id string, page long, text string")
    assert [(r.first_page, r.last_page, r.tokens) for r in docindex.chunk_pages(pages, 30, 1).orderBy("chunk").collect()] == [(1, 2, 20), (2, 3, 20), (3, 4, 20), (4, 5, 20)]
    toc = spark.createDataFrame([("a", "1", "A", 3, True), ("a", "1.1", "B", 4, False), ("a", "2", "C", 6, True)], "doc_id string, code string, title string, page int, starts_page boolean")
    got = [(r.code, r.start_page, r.end_page, r.parent_code) for r in docindex.outline(toc, spark.createDataFrame([("a", 9)], "doc_id string, pages int")).orderBy("start_page").collect()]
    assert got == [("0", 1, 2, None), ("1", 3, 4, None), ("1.1", 4, 5, "1"), ("2", 6, 9, None)]


def test_presets(spark):
    v = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (2, 1, "b")], "plant_id long, attribute_id long, value string")
    p = spark.createDataFrame([("p", 1, "a"), ("p", 1, "b"), ("p", 2, "x")], "preset string, attribute_id long, value string")
    assert [tuple(r) for r in eav.apply_presets(v, p).collect()] == [("p", 1)]


def test_stream_counts_match_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    out = streams.stream_evidence_counts(src, "1 day", time="ts", late="60 days", source="event_type")
    q = out.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").count()
    assert spark.table("counts").count() == want.count()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count()


def test_lookup_falls_back_on_synonyms(spark):
    long = spark.createDataFrame([("A", 1, "Acer rubrum", "c", "x"), ("G", 1, "Rosa", "c", "y")], "dataset string, source_row int, name string, column string, value string")
    kinds = spark.createDataFrame([("A", "synonymy"), ("G", "genus")], "dataset string, strategy string")
    syn = spark.createDataFrame([("Acer old", "Acer rubrum"), ("Acer rubrum", "Acer rubrum")], "original_name string, taxon_name string")
    names_df = spark.createDataFrame([("Acer old",), ("Acer rubrum",), ("Rosa canina",)], "name string")
    got = sorted((r.asked, r.value, r.confidence) for r in eav.lookup_sources(names_df, long, kinds, syn).collect())
    assert got == [("Acer old", "x", 0.9), ("Acer rubrum", "x", 1.0), ("Rosa canina", "y", 0.8)]


def test_offset_and_clip(spark):
    toc = spark.createDataFrame([("a", 1), ("a", 9)], "doc_id string, page int")
    got = docindex.apply_offset(toc, spark.createDataFrame([("a", 2)], "doc_id string, offset int"), spark.createDataFrame([("a", 10)], "doc_id string, pages int"))
    assert [(r.doc_id, r.page) for r in got.collect()] == [("a", 3)]


def test_page_and_batch_record(spark):
    df = spark.createDataFrame([(1, "minor"), (2, None), (3, "critical"), (4, "moderate"), (5, "critical")], "id long, severity string")
    ids = lambda *a, **k: [r.id for r in reports.page(df, *a, **k)[0].collect()]
    assert ids("severity") == [3, 5, 4, 1, 2] and ids("severity", 2, 2) == [4, 1] and ids("severity", 9, 2) == []
    assert ids("drop table", allowed=("id",), descending=True) == [5, 4, 3, 2, 1] and reports.page(df, "id", 2, 2)[1].first().total == 5
    row = claims.batch_record(df.union(df), "b", "abc").first()
    assert (row.id, row.claims_generated, row.notes, row.dolt_commit_hash) == ("b", 5, "Pushed 5 claim(s) to production", "abc")
    assert claims.batch_record(df.filter("id > 9"), "b").isEmpty()
