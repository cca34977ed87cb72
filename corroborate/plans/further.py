"""Registered queries of scalar rules, mappings, evidence bundles, verdicts, presets, files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import claims as cl
from ..operators import eav, evidence, harvest, reports
from ..sources import tables
from ..sources.scratch import folder
from ..streaming import sinks, streams
from . import adapters as ad
from . import registry as rg
from . import wider
from .adapters import sql
from .registry import CONFLICTS, register

# Names and scalar rules.


@register("SELECT p_partkey, split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS species, concat('(L.) ', p_brand) AS authority, concat(p_name, ' sold') AS name, 'Red Sun' AS cultivar, p_name AS bare FROM part")
def name_parts(spark, d):
    p = ad.table(spark, d, "part")
    full = names.parse_full_name(F.concat("p_name", F.lit("  (L.) "), "p_brand"))
    plant = names.parse_botanical(F.concat("p_name", F.lit(" ‘Red Sun’  sold")))
    return p.select("p_partkey", full["genus"].alias("genus"), full["species"].alias("species"), full["authority"].alias("authority"), plant["name"].alias("name"), plant["cultivar"].alias("cultivar"), names.strip_author(F.concat("p_name", F.lit(" Mill. ex L."))).alias("bare"))


ATTRIBUTE_NAMES = "CASE s_suppkey % 9 WHEN 0 THEN 'Flammability' WHEN 1 THEN 'Irrigation need' WHEN 2 THEN 'Browse by elk' WHEN 3 THEN 'Origin' WHEN 4 THEN 'Invasiveness' WHEN 5 THEN 'Lepidoptera' WHEN 6 THEN 'Native birds' WHEN 7 THEN 'NULL ' END"


@register("SELECT s_suppkey, ['fire', 'water', 'deer', 'native', 'invasive', 'wildlife', 'native', 'other', 'other'][s_suppkey % 9 + 1] AS category, s_suppkey % 9 >= 7 AS nullish, ['experimental', 'field_observation', NULL][s_suppkey % 3 + 1] AS methodology, ['national', 'local', 'regional', NULL][s_suppkey % 4 + 1] AS specificity, CASE WHEN s_suppkey % 2 = 0 THEN 'recent' END AS currency, ['Groundcover', 'Perennial', 'Tree', 'none'][s_suppkey % 4 + 1] AS page_band FROM supplier")
def source_rules(spark, d):
    s = ad.table(spark, d, "supplier").selectExpr(
        "s_suppkey", f"{ATTRIBUTE_NAMES} AS a", "CASE s_suppkey % 3 WHEN 0 THEN 'Laboratory' WHEN 1 THEN 'Survey' END AS m", "CASE s_suppkey % 4 WHEN 0 THEN 'International' WHEN 1 THEN 'N. California' WHEN 2 THEN 'Nevada, Idaho' ELSE '' END AS r", "CASE WHEN s_suppkey % 2 = 0 THEN '2014 ed.' ELSE 'ed. 2014' END AS y", "CASE s_suppkey % 4 WHEN 0 THEN '11, 14' WHEN 1 THEN '31' WHEN 2 THEN '43-53' ELSE 'x' END AS p",
    )
    bands = [(11, 16, "Groundcover"), (17, 31, "Perennial"), (32, 34, "Broadleaf Evergreen"), (35, 42, "Shrub"), (43, 53, "Tree")]
    return s.select("s_suppkey", F.coalesce(names.attribute_category("a"), F.lit("other")).alias("category"), names.is_nullish("a").alias("nullish"), names.infer_methodology("m").alias("methodology"), names.infer_specificity("r").alias("specificity"), names.infer_currency("y", 2026).alias("currency"), names.band("p", bands, "none").alias("page_band"))


@register("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size::DOUBLE ELSE 6.5 END AS low, CASE WHEN p_size % 2 = 0 THEN p_size + 4 ELSE 6.5 END::DOUBLE AS high, concat('[{\"v\":', CAST(p_size AS STRING), '}]') AS json, CASE p_type WHEN 'PROMO' THEN 'PROMO' ELSE 'NUANCED' END AS verdict, least(1, p_size / 40.0)::DOUBLE AS confidence, concat_ws(', ', CASE WHEN p_size % 3 = 0 THEN 'Tree:true' END, 'Color:04') AS mapped FROM part")
def text_rules(spark, d):
    p = ad.table(spark, d, "part")
    size = F.col("p_size").cast("string")
    r = names.parse_range(F.when(F.col("p_size") % 2 == 0, F.concat(size, F.lit("-"), (F.col("p_size") + 4).cast("string"), F.lit(" ft"))).otherwise("6.5 feet"))
    answer = F.concat(F.lit("Here:\n```json\n[{\"v\":"), size, F.lit("}]\n```\nDone."))
    habits = F.array(F.when(F.col("p_size") % 3 == 0, "Small TREE").otherwise("herb"), F.lit("dark red"))
    mapped = names.map_keywords(habits, [("tree", "Tree", "true"), ("red", "Color", "04"), ("rose", "Color", "04")])
    return p.select("p_partkey", r["low"].alias("low"), r["high"].alias("high"), names.extract_json(answer).alias("json"), names.validate_enum("p_type", ["PROMO"], "NUANCED").alias("verdict"), names.clamp(F.col("p_size") / 40.0).alias("confidence"), F.array_join(F.transform(mapped, lambda m: F.concat_ws(":", m["attribute"], m["value"])), ", ").alias("mapped"))


@register("SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'offer' ELSE 'other' END AS p_type_label FROM part")
def with_label(spark, d):
    return eav.with_label(ad.table(spark, d, "part").select("p_partkey", "p_type"), "p_type", {"ECONOMY": "cheap", "PROMO": "offer"}, "other").drop("p_type")


# Joins and mappings.


@register("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_size > 25 THEN concat('new ', p_brand) ELSE p_brand END AS p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS detail FROM part")
def merge_details(spark, d):
    p = ad.table(spark, d, "part")
    details = p.filter("p_partkey % 2 = 0").selectExpr("p_partkey", "CASE WHEN p_size > 25 THEN concat('new ', p_brand) END AS p_brand", "p_size AS detail")
    return eav.merge_details(p.select("p_partkey", "p_brand"), details, "p_partkey")


def _odd_mapping(spark, d):
    return ad.table(spark, d, "part").selectExpr("p_name AS source_column", "CASE WHEN p_size % 4 = 0 THEN 'SKIP' ELSE 'MAP' END AS mapping_type", "CAST(p_size % 9 AS BIGINT) AS target_attribute_id")


ODD_SQL = "SELECT p_name AS source_column, CASE WHEN p_size % 9 IN (0, 8) THEN 'UNCERTAIN' WHEN p_size % 4 = 0 THEN 'SKIP' ELSE 'MAP' END AS mapping_type, CASE WHEN p_size % 9 BETWEEN 1 AND 7 THEN p_size % 9 END AS target_attribute_id FROM part"


@register(ODD_SQL)
def validate_mapping(spark, d):
    return evidence.validate_mapping(_odd_mapping(spark, d), ad.attributes(spark, d))


@register(f"SELECT mapping_type, count(*) AS n FROM ({ODD_SQL}) GROUP BY 1")
def mapping_summary(spark, d):
    return evidence.mapping_summary(evidence.validate_mapping(_odd_mapping(spark, d), ad.attributes(spark, d)))


@register("SELECT DISTINCT concat(p_brand, ' ', CAST(p_size AS STRING)) AS source_column FROM part WHERE concat(p_brand, ' ', CAST(p_size AS STRING)) NOT IN (SELECT concat(p_brand, ' ', CAST(p_size AS STRING)) FROM part WHERE p_type = 'ECONOMY')")
def unmapped_headers(spark, d):
    p = ad.table(spark, d, "part").selectExpr("p_type", "concat(p_brand, ' ', p_size) AS source_column")
    return evidence.unmapped_headers(p, p.filter("p_type = 'ECONOMY'"))


@register("SELECT DISTINCT concat('at ', column1) AS attribute_name, p_brand AS dataset, column1 AS \"column\" FROM part CROSS JOIN (VALUES ('p_type'), ('P_Size')) v(column1)")
def attribute_sources(spark, d):
    cols = ad.table(spark, d, "part").selectExpr("p_brand AS dataset", "explode(array('p_type', 'P_Size', 'p_name')) AS column")
    known = spark.createDataFrame([("P_TYPE", "at p_type", False), ("p_size", "at P_Size", False), ("p_name", "sum", True)], "column string, attribute_name string, is_calculated boolean")
    return reports.attribute_sources(cols, known)


@register("SELECT p_partkey AS id, p_name AS name, p_type AS kind, 'parts' AS source_id FROM part UNION ALL SELECT s_suppkey, s_name, NULL, 'suppliers' FROM supplier")
def merge_sources(spark, d):
    return reports.merge_sources([("parts", ad.table(spark, d, "part").selectExpr("p_partkey AS id", "p_name AS name", "p_type AS kind")), ("suppliers", ad.table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name"))])


@register("SELECT p_name AS name, 'small' AS rating FROM part WHERE p_size < 10 UNION ALL SELECT p_name, 'large' FROM part WHERE p_size > 40")
def union_labelled(spark, d):
    p = ad.table(spark, d, "part")
    return harvest.union_labelled([("small", p.filter("p_size < 10").selectExpr("p_name AS name")), ("large", p.filter("p_size > 40").selectExpr("p_name AS name"))])


@register("SELECT p_partkey, 'Zone' AS label, CAST(p_size AS STRING) AS value FROM part UNION ALL SELECT p_partkey, 'Name', p_name FROM part")
def definition_pairs(spark, d):
    html = "concat('<dl><dt class=\"a\">Zone</dt> <dd><b>', p_size, '</b></dd><DT>Name</DT>', chr(10), '<dd>', p_name, '</dd></dl>') AS html"
    return harvest.definition_pairs(ad.table(spark, d, "part").selectExpr("p_partkey", html), "p_partkey", "html")


PAGE = """concat('<table><tr><th>Name</th><th>Size</th></tr><tr><td>', p_name, ' <i>x</i></td><td> ', p_size, '</td></tr></table>') AS html"""


@register("SELECT p_partkey AS page_id, 0 AS table_no, 0 AS row_no, 'Name|Size' AS cells, TRUE AS is_header FROM part UNION ALL SELECT p_partkey, 0, 1, concat(p_name, ' x|', CAST(p_size AS STRING)), FALSE FROM part")
def html_table_rows(spark, d):
    return harvest.html_tables(ad.table(spark, d, "part").selectExpr("p_partkey AS page_id", PAGE)).drop("table_id", "link").withColumn("cells", F.array_join("cells", "|"))


@register(sql("SELECT plant_id, attribute_id, count(*) AS n_warrants FROM w WHERE status <> 'excluded' AND warrant_type = 'existing' AND plant_id IN (1, 2, 3, 5, 8, 13, 21) AND attribute_id = 3 GROUP BY 1, 2 HAVING count(*) >= 3", "w"))
def warrant_groups_filtered(spark, d):
    return evidence.warrant_groups(ad.warrants(spark, d), "internal", 3, [1, 2, 3, 5, 8, 13, 21], "BUTE 3")


@register(sql("SELECT a.id AS attribute_id, 'attribute 1' AS category, count(DISTINCT w.plant_id) AS n_entities FROM a LEFT JOIN w ON w.attribute_id = a.id WHERE a.id NOT IN (1, 3) GROUP BY 1", "w", "a"))
def attribute_coverage_of(spark, d):
    out = eav.attribute_coverage(ad.entities(spark, d), ad.attributes(spark, d), ad.values(spark, d), "Attribute 1", "name", (3,))
    return out.select("attribute_id", "category", "n_entities")


# Presets and calculated attributes.

SPECS = [("fire", '{"fire": {"matchMode": "all", "list": ["AF", "RF"], "zone": ["NO"]}}'), ("tall", '{"fire": {"list": ["AF", "RF", "NO"]}, "heightRange": {"min": 10, "max": 30}}')]


@register(sql("WITHX SELECT 'fire' AS preset, plant_id FROM w GROUP BY plant_id HAVING count_if(attribute_id = 1 AND value IN ('AF', 'RF')) > 0 AND count_if(attribute_id = 2 AND value = 'NO') > 0 UNION ALL SELECT 'tall', plant_id FROM w JOIN part ON p_partkey = plant_id WHERE p_size BETWEEN 10 AND 30 GROUP BY plant_id HAVING count_if(attribute_id = 1 AND value IN ('AF', 'RF', 'NO')) > 0", "w").replace("WITHX ", ""))
def preset_specs(spark, d):
    fields = spark.createDataFrame([("fire", "list", 1), ("fire", "zone", 2)], "category string, field string, attribute_id long")
    rows, bounds = eav.preset_rows(spark.createDataFrame(SPECS, "preset string, filters string"), fields)
    heights = ad.table(spark, d, "part").selectExpr("p_partkey AS plant_id", "concat(p_size, '-', p_size + 5, ' ft') AS height")
    return eav.within_heights(eav.apply_presets(ad.values(spark, d), rows), bounds, heights)


@register(sql("SELECT plant_id, " + ", ".join(f"max(CASE WHEN attribute_id = {i % 7 + 1} THEN 1 ELSE 0 END) AS has_{n}" for i, n in enumerate(eav.HAS_FLAGS)) + ", greatest(0, least(6, CAST(sum(CASE WHEN attribute_id = 2 THEN CASE value WHEN 'NO' THEN 1 WHEN 'RF' THEN 2 ELSE 0 END ELSE 0 END) AS BIGINT))) AS wildlife, greatest(-3, least(0, CAST(sum(CASE WHEN attribute_id = 3 AND value = 'AF' THEN -1 ELSE 0 END) AS BIGINT))) AS invasive, wildlife + invasive AS total FROM w GROUP BY 1", "w"))
def calculated_attributes(spark, d):
    """The twelve flags, with the attributes of the given table in the place of the declared ones."""
    flags = {n: i % 7 + 1 for i, n in enumerate(eav.HAS_FLAGS)}
    return eav.calculated_attributes(ad.values(spark, d), {"NO": 1, "RF": 2}, {"AF": -1}, flags, 2, 3)


# Conflicts: evidence, rules, verdicts.


def _documents(spark, d):
    return ad.table(spark, d, "supplier").selectExpr("concat('S', CAST(s_suppkey AS STRING)) AS source_dataset", "repeat(s_name, 300) AS dictionary", "s_name AS readme")


def _bundle(spark, d):
    w = ad.warrants(spark, d).groupBy("id").agg(F.min("source_id").alias("source_dataset"), F.min("batch_id").alias("source_year")).withColumn("source_region", F.lit("Oregon"))
    nodes = ad.table(spark, d, "customer").selectExpr("c_mktsegment AS doc_id", "c_custkey AS node_id", "concat('attribute ', c_custkey % 40) AS title", "CAST(NULL AS STRING) AS summary")
    return evidence.evidence_bundle(rg._conflicts(spark, d), w, _documents(spark, d), nodes, attributes=ad.attributes(spark, d))


@register(sql("WITHX SELECT x.id, a.y AS source_year_a, b.y AS source_year_b, CASE WHEN da.s_name IS NOT NULL THEN least(3000, 300 * length(da.s_name)) END AS dictionary_length_a, db.s_name AS readme_b, (SELECT string_agg(CAST(node_id AS STRING), ',' ORDER BY r) FROM (SELECT k.attribute_id, c_custkey AS node_id, row_number() OVER (PARTITION BY k.attribute_id ORDER BY CASE WHEN contains(concat('attribute ', CAST(c_custkey % 40 AS STRING)), CAST(k.attribute_id AS STRING)) THEN 6 ELSE 3 END DESC, c_mktsegment, c_custkey) AS r FROM customer CROSS JOIN (SELECT DISTINCT attribute_id FROM x) k) z WHERE z.attribute_id = x.attribute_id AND r <= 5) AS sections FROM x LEFT JOIN (SELECT id, min(source_id) AS s, min(batch_id) AS y FROM w GROUP BY 1) a ON a.id = x.warrant_a_id LEFT JOIN (SELECT id, min(source_id) AS s, min(batch_id) AS y FROM w GROUP BY 1) b ON b.id = x.warrant_b_id LEFT JOIN supplier da ON a.s = concat('S', CAST(da.s_suppkey AS STRING)) LEFT JOIN supplier db ON b.s = concat('S', CAST(db.s_suppkey AS STRING))", *CONFLICTS).replace("WITHX ", "").replace("CASE WHEN contains(concat('attribute ', CAST(c_custkey % 40 AS STRING)), CAST(k.attribute_id AS STRING)) THEN 6 ELSE 3 END", "CASE WHEN length(CAST(k.attribute_id AS STRING)) >= 2 AND contains(concat('attribute ', CAST(c_custkey % 40 AS STRING)), CAST(k.attribute_id AS STRING)) THEN 6 ELSE 3 END"))
def evidence_bundle(spark, d):
    b = _bundle(spark, d)
    return b.select("id", "source_year_a", "source_year_b", F.length("dictionary_a").alias("dictionary_length_a"), "readme_b", F.array_join(F.transform("sections", lambda s: s["node_id"].cast("string")), ",").alias("sections"))


@register(sql("SELECT id, CASE WHEN plant_id % 3 = 0 THEN 'unknown' WHEN plant_id % 3 = 1 THEN 'disjoint' ELSE 'same' END AS scope, attribute_id % 2 = 0 AS granular FROM x", *CONFLICTS))
def scope_and_granularity(spark, d):
    x = rg._conflicts(spark, d).selectExpr("id", "plant_id", "CASE plant_id % 3 WHEN 1 THEN 'S. Oregon' WHEN 2 THEN 'CALIFORNIA' END AS ra", "CASE plant_id % 3 WHEN 1 THEN 'Spain' ELSE 'oregon' END AS rb", "CASE WHEN attribute_id % 2 = 0 THEN 'Acer spp.' ELSE 'Acer rubrum' END AS na", "'Acer negundo' AS nb")
    return x.select("id", evidence.scope_flag("ra", "rb", ["Oregon", "California"]).alias("scope"), evidence.granularity("na", "nb").alias("granular"))


@register(sql("SELECT id, CASE conflict_type WHEN 'DEFINITION_CONFLICT' THEN 'Definition' ELSE 'Methodology' END || ' conflict requires human review. Source A (' || coalesce(source_a, 'Unknown') || ') methodology: Unknown. Source B (' || coalesce(source_b, 'Unknown') || ') methodology: Unknown.' || chr(10) || chr(10) || '--- Source A Data Dictionary ---' || chr(10) || 'No data dictionary available.' || chr(10) || chr(10) || '--- Source B Data Dictionary ---' || chr(10) || 'No data dictionary available.' AS analysis, 'NUANCED' AS verdict, 'HUMAN_DECIDE' AS recommendation, 0.0::DOUBLE AS confidence FROM x WHERE conflict_type IN ('METHODOLOGY_DIFFERENCE', 'DEFINITION_CONFLICT')", *CONFLICTS))
def default_verdicts(spark, d):
    return evidence.default_verdicts(rg._conflicts(spark, d))


@register(sql("SELECT id, CASE WHEN conflict_type IN ('METHODOLOGY_DIFFERENCE', 'DEFINITION_CONFLICT') THEN 'annotated' ELSE status END AS status, CASE WHEN conflict_type IN ('METHODOLOGY_DIFFERENCE', 'DEFINITION_CONFLICT') THEN 'NUANCED' END AS specialist_verdict FROM x", *CONFLICTS))
def apply_verdicts(spark, d):
    x = rg._conflicts(spark, d).withColumns({"specialist_verdict": F.lit(None).cast("string"), "specialist_recommendation": F.lit(None).cast("string")})
    return evidence.apply_verdicts(x, evidence.default_verdicts(x).dropDuplicates(["id"])).select("id", "status", "specialist_verdict")


@register(sql("SELECT id, CASE WHEN conflict_mode = 'cross_source' THEN 6 WHEN severity = 'minor' THEN 5 WHEN severity = 'critical' THEN CASE conflict_mode WHEN 'internal' THEN 1 ELSE 2 END ELSE CASE conflict_mode WHEN 'internal' THEN 3 ELSE 4 END END AS priority FROM x", *CONFLICTS))
def resolution_queue(spark, d):
    return evidence.resolution_queue(rg._conflicts(spark, d)).select("id", "priority")


@register(sql("SELECT c.id AS claim_id, w.id AS warrant_id, w.value, w.source_id, w.created_at FROM c JOIN w USING (plant_id, attribute_id) WHERE c.status = 'approved' AND w.status <> 'excluded' AND w.created_at > c.approved_at", "w", "c"))
def later_warrants(spark, d):
    return cl.later_warrants(ad.claims(spark, d), ad.warrants(spark, d))


@register(f"SELECT source_id, auto_score, CASE WHEN CAST(substr(source_id, 2) AS BIGINT) % 3 = 0 THEN 0.99::DOUBLE ELSE 0.5::DOUBLE END AS reliability_score, CASE WHEN CAST(substr(source_id, 2) AS BIGINT) % 3 = 0 THEN 'admin' ELSE 'seed' END AS updated_by FROM ({rg.SCORE})")
def update_reliability(spark, d):
    """Stewards set the score of every third source; the automatic one is computed anew for all."""
    rel = rg._reliability(spark, d).withColumns({"reliability_score": F.lit(0.5), "updated_by": F.lit("seed")})
    patch = rel.filter("CAST(substr(source_id, 2) AS BIGINT) % 3 = 0").select("source_id", F.lit(0.99).alias("reliability_score"))
    return cl.rescore(cl.update_reliability(rel, patch)).select("source_id", "auto_score", "reliability_score", "updated_by")


# Files: written from the tables, then read back.


@register("SELECT concat('a, \"', p_name, '\"', chr(10), 'b') AS name, CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS size, p_brand AS brand FROM part")
def read_source_csv(spark, d):
    at = folder(spark)
    p = ad.table(spark, d, "part").selectExpr("concat('  a, \"', p_name, '\"', chr(10), 'b ') AS name", "CASE WHEN p_size % 5 <> 0 THEN concat(' ', p_size) END AS size", "p_brand AS brand")
    blank = spark.createDataFrame([("", " ", None)], "name string, size string, brand string")
    p.unionByName(blank).write.csv(at, header=True, escape='"', quoteAll=True)
    return tables.read_source_csv(spark, at)


@register("SELECT name, size_in_ft FROM (SELECT p_name AS name, CAST(p_size AS STRING) AS size_in_ft FROM part)")
def read_delimited(spark, d):
    at = folder(spark)
    ad.table(spark, d, "part").selectExpr("p_name AS name", "CAST(p_size AS STRING) AS `size (in ft)`").write.csv(at, header=True, sep="|")
    return tables.read_delimited(spark, at, "|")


@register("SELECT 'parts' AS \"table\", 'id, name' AS columns, concat_ws('|', CAST(p_partkey AS STRING), CASE WHEN p_size % 4 = 0 THEN '' ELSE p_name END) AS cells FROM part UNION ALL SELECT 'nations', 'name', n_name FROM nation")
def tables_from_sql_dump(spark, d):
    """A folder of dumps, written side by side: each task writes whole blocks, their head before the rows and their end after them."""
    at = folder(spark)
    lines = ad.table(spark, d, "part").selectExpr("p_partkey % 8 AS block", "p_partkey AS at", "concat_ws('\t', p_partkey, CASE WHEN p_size % 4 = 0 THEN '\\\\N' ELSE p_name END) AS value")
    nations = ad.table(spark, d, "nation").selectExpr("8 AS block", "n_nationkey AS at", "n_name AS value")
    head = "CASE WHEN block < 8 THEN 'COPY public.parts (id, name) FROM stdin;' ELSE 'COPY public.\"nations\" (name) FROM stdin;' END"
    marks = spark.range(9).selectExpr("id AS block").selectExpr("block", f"stack(3, -2L, '-- data', -1L, {head}, 9223372036854775807L, '\\\\.') AS (at, value)")
    lines.unionByName(nations).unionByName(marks).repartition("block").sortWithinPartitions("block", "at").select("value").write.text(at)
    out = tables.tables_from_sql_dump(spark, at)
    return out.select("table", F.array_join("columns", ", ").alias("columns"), F.array_join("cells", "|").alias("cells"))


def _mirror(spark, d):
    at = folder(spark)
    for t in ("nation", "region"):
        ad.table(spark, d, t).write.csv(f"{at}/{t}.csv", header=True)
    return tables.import_tables(spark, at, ["nation", "region"])


@register("SELECT CAST(n_nationkey AS STRING) AS n_nationkey, n_name, CAST(n_regionkey AS STRING) AS n_regionkey FROM nation")
def import_tables(spark, d):
    return _mirror(spark, d)["nation"]


@register("SELECT 'nation' AS \"table\", count(*) AS expected, count(*) AS actual, TRUE AS ok FROM nation UNION ALL SELECT 'region', -1, count(*), FALSE FROM region UNION ALL SELECT 'lost', 3, NULL, FALSE")
def verify_counts(spark, d):
    expected = ad.table(spark, d, "nation").agg(F.count("*").alias("expected")).select(F.lit("nation").alias("table"), "expected").unionByName(spark.createDataFrame([("region", -1), ("lost", 3)], "table string, expected long"))
    return tables.verify_counts(expected, _mirror(spark, d))


@register("SELECT p_name AS name, member FROM (SELECT p_name, unnest(['a', CASE WHEN p_size % 2 = 0 THEN 'b' END]) AS member FROM part) WHERE member IS NOT NULL")
def write_by_member(spark, d):
    at = folder(spark)
    tables.write_by_member(ad.table(spark, d, "part").selectExpr("p_name AS name", "CASE WHEN p_size % 2 = 0 THEN 'a, b' ELSE 'a,' END AS lists"), "lists", at)
    return spark.read.parquet(at).select("name", "member")


@register("SELECT p_partkey AS id, coalesce(CASE WHEN p_size % 3 <> 0 THEN p_name END, p_brand || ' spp.') AS name FROM part")
def scientific_names(spark, d):
    p = ad.table(spark, d, "part").selectExpr("p_partkey AS id", "'' AS scientific_name", "CASE WHEN p_size % 3 = 0 THEN ' ' ELSE p_name END AS species", "p_brand AS genus")
    return p.select("id", tables.scientific_name_col(p).alias("name"))


@register("SELECT concat('D', CAST(s_suppkey AS STRING)) AS dataset, concat('FIRE-', lpad(CAST(s_suppkey % 90 AS STRING), 2, '0')) AS source_id, 'FIRE' AS category, CASE WHEN s_suppkey % 2 = 0 THEN 1000 + s_suppkey ELSE s_suppkey END AS n_records FROM supplier")
def dataset_registry(spark, d):
    s = ad.table(spark, d, "supplier")
    readmes = s.selectExpr("concat('D', s_suppkey) AS dataset", "concat('Source: FIRE-', lpad(CAST(s_suppkey % 90 AS STRING), 2, '0'), chr(10), CASE WHEN s_suppkey % 2 = 0 THEN concat('Holds ', format_number(1000 + s_suppkey, 0), ' records') ELSE '' END) AS text")
    return tables.dataset_registry(readmes, s.selectExpr("concat('D', s_suppkey) AS dataset", "s_suppkey AS n_rows"))


# Streams, run to the end of what is there.


def _drained(stream, path: str, mode: str, schema_of):
    """All that a stream puts out, by way of files: appended, or what the last batch says."""
    q = stream.writeStream.foreachBatch(sinks.once_per_batch(f"{path}/out")).option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    spark = schema_of.sparkSession
    return sinks.batches(spark, f"{path}/out", stream.schema).drop("batch_id") if mode == "append" else sinks.latest(spark, f"{path}/out", stream.schema)


def _stream(spark, d, name):
    return spark.readStream.schema(ad.table(spark, d, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


@register("SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS day FROM events")
def stream_warrants(spark, d):
    src = _stream(spark, d, "events").selectExpr("user_id", "event_type", "date_trunc('day', ts) AS day", "ts AS created_at")
    out = streams.stream_warrants(src, ["user_id", "event_type", "day"], late="3650 days").select("user_id", "event_type", F.col("day").cast("timestamp_ntz").alias("day"))
    return _drained(out, folder(spark), "append", ad.table(spark, d, "events"))


@register("SELECT event_type AS source, count(*) AS n FROM events GROUP BY 1, date_trunc('day', ts)")
def stream_evidence_counts(spark, d):
    out = streams.stream_evidence_counts(_stream(spark, d, "events"), "1 day", time="ts", source="event_type")
    return _drained(out, folder(spark), "complete", ad.table(spark, d, "events")).select("source", "n")


@register(sql("SELECT c.id AS claim_id, w.id AS warrant_id FROM c JOIN w USING (plant_id, attribute_id) WHERE c.status = 'approved' AND w.status <> 'excluded' AND w.created_at > c.approved_at", "w", "c"))
def stream_stale(spark, d):
    out = streams.stream_stale(_stream(spark, d, "lineitem").selectExpr(*ad.WARRANTS), ad.claims(spark, d)).select("claim_id", "warrant_id")
    return _drained(out, folder(spark), "append", ad.table(spark, d, "events"))


@register("WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER v + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW v AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, count(*) AS n FROM s GROUP BY user_id, k")
def stream_sessions(spark, d):
    out = streams.stream_sessions(_stream(spark, d, "events"))
    return _drained(out, folder(spark), "complete", ad.table(spark, d, "events")).select("user_id", "n")


_ = wider  # registered before this module
