"""More registered queries: names, matching, mapping, reports, claims, dataset building and the document index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import claims as cl
from ..operators import docindex, eav, evidence, harvest, matching, reports
from ..sources import tables
from . import adapters as ad
from . import registry as rg
from .adapters import sql
from .registry import CONFLICTS, PAIRS, register

# Names and scalar rules.


@register(f"WITH names AS ({rg.NAMES_SQL}) SELECT name, split_part(name, ' ', 1) AS genus, CASE WHEN name NOT LIKE '% spp.' AND NOT regexp_matches(split_part({rg.BARE_SQL}, ' ', 2), '^[A-Z]') THEN nullif(split_part({rg.BARE_SQL}, ' ', 2), '') END AS species, CASE WHEN name LIKE '%''Red''' THEN 'Red' END AS cultivar, species IS NULL AS is_genus_only FROM names")
def parse_name(spark, d):
    return rg._names(spark, d).select("name", names.parse_name("name").alias("p")).select("name", "p.*")


@register("SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'very high' WHEN p_size >= 20 THEN 'high' WHEN p_size >= 10 THEN 'medium' ELSE 'low' END AS tier, CASE p_type WHEN 'ECONOMY' THEN 'E' WHEN 'PROMO' THEN 'P' END AS code, CASE p_type WHEN 'ECONOMY' THEN 'economy' WHEN 'PROMO' THEN 'promotion' ELSE p_type END AS label, CASE WHEN 2026 - (2000 + p_size) <= 5 THEN 'current' WHEN 2026 - (2000 + p_size) <= 15 THEN 'recent' ELSE 'dated' END AS currency, round(1 - levenshtein(lower(p_name), lower(p_type))::DOUBLE / greatest(length(p_name), length(p_type)), 9) AS sim FROM part")
def scalar_rules(spark, d):
    label = names.crosswalk("p_type", {"ECONOMY": ("E", "economy"), "PROMO": ("P", "promotion")})
    return ad.table(spark, d, "part").select("p_partkey", names.tier("p_size", [(40, "very high"), (20, "high"), (10, "medium")], "low").alias("tier"), label["code"].alias("code"), label["label"].alias("label"), names.infer_currency((F.col("p_size") + 2000).cast("string"), 2026).alias("currency"), F.round(names.similarity("p_name", "p_type"), 9).alias("sim"))


# Matching.

BACKBONE = ["concat(p_name, ' ', p_brand) AS name_full", "concat(p_brand, '/', CAST(p_size % 10 AS STRING)) AS symbol", "length(p_name) % 2 AS is_synonym"]
RESOLVE_SQL = f"b AS (SELECT {', '.join(BACKBONE)} FROM part), n AS (SELECT DISTINCT trim(p_name) AS name FROM part), h AS (SELECT name, symbol, name_full, is_synonym, row_number() OVER (PARTITION BY name ORDER BY is_synonym, lower(name_full), symbol) AS r FROM n JOIN b ON starts_with(lower(name_full), lower(name))), t AS (SELECT symbol, min(name_full) AS target FROM b WHERE is_synonym = 0 GROUP BY 1), z AS (SELECT name, CASE WHEN is_synonym = 0 THEN name_full ELSE target END AS accepted, is_synonym = 1 AS followed FROM h LEFT JOIN t USING (symbol) WHERE r = 1 AND (is_synonym = 0 OR target IS NOT NULL))"


@register(f"WITH {RESOLVE_SQL} SELECT n.name, coalesce(accepted, upper(n.name)) AS accepted, CASE WHEN followed THEN n.name END AS synonym_of, CASE WHEN accepted IS NULL THEN 'second' ELSE 'first' END AS source, CASE WHEN followed THEN 0.95 ELSE 1.0 END::DOUBLE AS confidence FROM n LEFT JOIN z USING (name)")
def resolve_name(spark, d):
    p = ad.table(spark, d, "part")
    return matching.resolve_name(p.selectExpr("p_name AS name"), [("first", p.selectExpr(*BACKBONE)), ("second", p.selectExpr("upper(p_name) AS name_full"))])


@register(f"{rg.MATCH_CTE}, q AS (SELECT lower(genus) AS g, count(*) AS n_in_genus, min(id) AS one FROM e GROUP BY 1) SELECT name, n_in_genus, CASE WHEN n_in_genus = 1 THEN one END AS plant_id FROM p JOIN q USING (g)")
def match_genus(spark, d):
    return matching.match_genus(rg._names(spark, d), ad.entities(spark, d))


@register(f"SELECT match_type, count(*) AS n FROM ({rg.ORACLES['match_entities']}) GROUP BY 1")
def match_summary(spark, d):
    return matching.match_summary(rg._matches(spark, d))


@register(f"WITH k AS ({rg.ORACLES['match_entities']}), e AS ({ad.CTE['e']}) SELECT k.name, match_type, plant_id FROM k WHERE NOT (match_type = 'GENUS_ONLY' AND plant_id IS NULL) UNION ALL SELECT k.name, match_type, e.id FROM k LEFT JOIN e ON lower(e.genus) = lower(split_part(k.name, ' ', 1)) WHERE match_type = 'GENUS_ONLY' AND plant_id IS NULL")
def expand_genus(spark, d):
    e = ad.entities(spark, d)
    return matching.expand_genus(rg._matches(spark, d), e).select("name", "match_type", "plant_id")


def _gaps(spark, d):
    e = ad.entities(spark, d)
    return eav.gap_matrix(e, ad.attributes(spark, d), ad.values(spark, d)).join(e.select(F.col("id").alias("plant_id"), "genus", "species"), "plant_id")


@register(f"WITH k AS ({rg.ORACLES['enrichment_candidates']}), g AS ({rg.ORACLES['gap_matrix']}), e AS ({ad.CTE['e']}) SELECT attribute_id, n_gaps, coalesce(n_names, 0) AS n_names, coalesce(sources, '') AS sources FROM (SELECT attribute_id, count(*) AS n_gaps FROM g GROUP BY 1) LEFT JOIN (SELECT attribute_id, count(DISTINCT lower(concat(genus, ' ', species))) AS n_names FROM k JOIN e ON e.id = k.plant_id GROUP BY 1) USING (attribute_id) LEFT JOIN (SELECT attribute_id, string_agg(concat(source, ':', CAST(n AS STRING)), ', ' ORDER BY source) AS sources FROM (SELECT attribute_id, source, count(*) AS n FROM k GROUP BY 1, 2) GROUP BY 1) USING (attribute_id)")
def enrichment_summary(spark, d):
    gaps = _gaps(spark, d)
    src = ad.table(spark, d, "part").selectExpr("CAST(p_size % 7 + 1 AS BIGINT) AS attribute_id", "p_type AS source", "p_name AS name", "p_brand AS value", "p_partkey AS source_row")
    out = matching.enrichment_summary(gaps, matching.enrichment_candidates(gaps, src))
    return out.withColumn("sources", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["source"], s["n"])), ", "))


@register("WITH n AS (SELECT DISTINCT p_name AS name FROM part), x AS (SELECT p_name AS name, min(p_brand) AS family FROM part WHERE p_size <= 3 GROUP BY 1), y AS (SELECT p_name AS name, min(p_brand) AS family, min(p_type) AS lifeform FROM part GROUP BY 1) SELECT n.name, coalesce(x.family, y.family) AS family, y.lifeform, concat_ws(', ', CASE WHEN x.name IS NOT NULL THEN 'few' END, CASE WHEN y.name IS NOT NULL THEN 'all' END) AS sources FROM n LEFT JOIN x USING (name) LEFT JOIN y USING (name)")
def taxonomy_profile(spark, d):
    p = ad.table(spark, d, "part")
    every = p.selectExpr("p_name AS name", "p_brand AS family", "p_type AS lifeform")
    few = p.filter("p_size <= 3").selectExpr("p_name AS name", "p_brand AS family")
    return eav.taxonomy_profile(every, [("few", few), ("all", every)], ["family", "lifeform"]).withColumn("sources", F.array_join("sources", ", "))


@register("SELECT lower(p_name) AS name FROM part WHERE p_brand = 'Brand#1' INTERSECT SELECT lower(p_name) FROM part WHERE p_size > 40")
def cross_reference(spark, d):
    p = ad.table(spark, d, "part")
    return eav.cross_reference(p.filter("p_brand = 'Brand#1'").selectExpr("p_name AS name"), p.filter("p_size > 40").selectExpr("p_name AS name"))


@register("WITH d AS (SELECT p_partkey, string_split(p_name, ' ') AS b, string_split(p_brand, '#') AS g FROM part) SELECT p_partkey, trim(bad) AS bad, trim(good) AS good FROM d, unnest(b) x(bad), unnest(g) y(good)")
def swap_pairs(spark, d):
    return eav.swap_pairs(ad.table(spark, d, "part").selectExpr("p_partkey", "replace(p_name, ' ', ';') AS bad", "replace(p_brand, '#', ';') AS good"))


@register("WITH d AS (SELECT l_partkey, coalesce(string_agg(DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN concat('A', CAST(l_suppkey % 50 AS STRING)) END, ', ' ORDER BY CASE WHEN l_linenumber % 2 = 0 THEN concat('A', CAST(l_suppkey % 50 AS STRING)) END), '') AS native_to, coalesce(string_agg(DISTINCT CASE WHEN l_linenumber % 2 = 1 THEN concat('A', CAST(l_suppkey % 50 AS STRING)) END, ', ' ORDER BY CASE WHEN l_linenumber % 2 = 1 THEN concat('A', CAST(l_suppkey % 50 AS STRING)) END), '') AS introduced_to FROM lineitem GROUP BY 1) SELECT p_partkey AS plant_name_id, native_to, introduced_to FROM part LEFT JOIN d ON l_partkey = p_partkey WHERE p_size % 2 = 0")
def build_backbone(spark, d):
    n = ad.table(spark, d, "part").selectExpr("p_partkey AS plant_name_id", "CASE WHEN p_size % 2 = 0 THEN 'Accepted' ELSE 'Synonym' END AS taxon_status", "'Species' AS taxon_rank")
    dist = ad.table(spark, d, "lineitem").selectExpr("l_partkey AS plant_name_id", "concat('A', CAST(l_suppkey % 50 AS STRING)) AS area", "CAST(l_linenumber % 2 AS STRING) AS introduced")
    return eav.build_backbone(n, dist).select("plant_name_id", "native_to", "introduced_to")


# The store.


@register(sql("SELECT w.id, a.name AS attribute_name, a.name AS path, s.name AS source_name, source_id IS NULL AS is_calculated FROM w JOIN a ON a.id = w.attribute_id LEFT JOIN s ON s.id = w.source_id", "w", "a", "s"))
def entity_values(spark, d):
    attrs = ad.attributes(spark, d).withColumn("parent_attribute_id", F.lit(None).cast("long"))
    return eav.entity_values(ad.values(spark, d), attrs, ad.sources(spark, d)).select("id", "attribute_name", "path", "source_name", "is_calculated")


@register(sql("SELECT id, name, common_name FROM e ORDER BY common_name DESC, id LIMIT 50 OFFSET 50", "e"))
def entity_page(spark, d):
    return reports.page(ad.entities(spark, d), "common_name", 2, descending=True, allowed=("name", "common_name"))[0].select("id", "name", "common_name")


@register(sql("SELECT id, name FROM e WHERE contains(lower(concat(genus, ' ', species)), 'ring') OR contains(lower(common_name), 'ring')", "e"))
def search_entities(spark, d):
    return eav.search_entities(ad.entities(spark, d), "Ring").select("id", "name")


MARKED = ["id", "CASE WHEN value = 'NO' THEN '' WHEN value = 'RF' THEN NULL ELSE value END AS value", "CASE WHEN attribute_id = 1 THEN 'x' WHEN attribute_id = 2 THEN 'seen' END AS source_value"]


@register(sql(f"SELECT id, coalesce(value, source_value) AS value FROM (SELECT {', '.join(MARKED)} FROM w) WHERE NOT (coalesce(value, '') = '' AND coalesce(source_value, '') IN ('', 'x'))", "w"))
def effective_value(spark, d):
    return eav.effective_value(eav.drop_markers(ad.values(spark, d).selectExpr(*MARKED))).select("id", "value")


@register(sql("SELECT id, plant_id, attribute_id, value FROM w WHERE attribute_id IN (SELECT id FROM a WHERE id >= 6) AND plant_id IN (SELECT id FROM e WHERE common_name = 'Brand#1')", "w", "a", "e"))
def values_bulk(spark, d):
    attrs = ad.attributes(spark, d).filter("id >= 6").selectExpr("id AS attribute_id")
    some = ad.entities(spark, d).filter("common_name = 'Brand#1'").selectExpr("id AS plant_id")
    return eav.values_bulk(ad.values(spark, d), attrs, some).select("id", "plant_id", "attribute_id", "value")


def _listed(spark, d, allowed):
    return ad.attributes(spark, d).withColumn("values_allowed", F.when(F.col("id") <= 3, F.lit(allowed)))


@register(sql("SELECT id, CASE WHEN attribute_id <= 3 AND value = 'NO' THEN 'open' ELSE value END AS display FROM w", "w"))
def resolve_values(spark, d):
    return eav.resolve_values(ad.values(spark, d), _listed(spark, d, '[{"id":"NO","displayName":"open"}]')).select("id", "display")


@register(sql("SELECT id, attribute_id > 3 OR lower(value) IN ('no', 'af') AS valid FROM w", "w"))
def validate_categorical(spark, d):
    return cl.validate_categorical(ad.values(spark, d), _listed(spark, d, "no, AF")).select("id", "valid")


@register(sql("SELECT id, value, 'no, af' AS allowed_set FROM w WHERE attribute_id <= 3 AND value <> 'AF' AND value <> 'NO'", "w"))
def audit_values(spark, d):
    return evidence.audit_values(ad.values(spark, d), _listed(spark, d, '[{"id":"NO","displayName":"no"},{"id":"AF","displayName":"af"}]')).select("id", "value", "allowed_set")


@register(f"SELECT round(avg(pct), 1) AS mean_pct, count_if(pct < 50) AS under_half, count(*) AS n_attributes FROM ({rg.ORACLES['attribute_coverage']})")
def coverage_headline(spark, d):
    return eav.coverage_headline(eav.attribute_coverage(ad.entities(spark, d), ad.attributes(spark, d), ad.values(spark, d)))


# Mapping and evidence.

MAPPING = [("p_type", "MAP", 1, {"ECONOMY": "cheap", "promo": "offer"}), ("p_brand", "MAP", 2, None), ("p_size", "SKIP", 3, None)]
MAPPED_SQL = "SELECT p_partkey AS source_row, 'p_type' AS source_column, p_type AS source_value, 1::BIGINT AS target_attribute_id, CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'offer' ELSE p_type END AS value, p_type NOT IN ('ECONOMY', 'PROMO') AS missed FROM part UNION ALL SELECT p_partkey, 'p_brand', p_brand, 2, p_brand, FALSE FROM part"


def _mapped(spark, d):
    rows = ad.table(spark, d, "part").selectExpr("p_partkey AS source_row", "p_type", "p_brand", "p_size")
    return evidence.apply_mapping(rows, spark.createDataFrame(MAPPING, "source_column string, mapping_type string, target_attribute_id long, crosswalk map<string,string>"))


@register(MAPPED_SQL)
def apply_mapping(spark, d):
    return _mapped(spark, d)


def _enhanced(spark, d):
    rows = ad.table(spark, d, "part").selectExpr("p_partkey AS source_row", "p_name AS name")
    m = matching.match_exact(rows, ad.entities(spark, d)).select(F.lower("name").alias("name_key"), "plant_id", F.lit("EXACT").alias("match_type"), F.lit(1.0).alias("confidence"))
    return evidence.enhance(_mapped(spark, d), rows, m, "parts", "b1")


ENHANCED_SQL = f"WITH k AS ({MAPPED_SQL}), i AS (SELECT p_name, min(p_partkey) AS plant_id FROM part GROUP BY 1) SELECT k.source_row, k.source_column, i.plant_id, k.target_attribute_id AS attribute_id, k.value, k.missed AS flagged FROM k JOIN part ON p_partkey = k.source_row JOIN i USING (p_name)"


@register(ENHANCED_SQL)
def enhance(spark, d):
    return _enhanced(spark, d).select("source_row", "source_column", "plant_id", "attribute_id", "value", "flagged")


@register(f"SELECT count(*) AS created, count_if(flagged) AS flagged, count(DISTINCT plant_id) AS entities, count(DISTINCT attribute_id) AS attributes, (SELECT 2 * count(*) FROM part WHERE length(split_part(p_name, ' ', 1)) % 2 = 1) AS skipped FROM ({ENHANCED_SQL}) JOIN part ON p_partkey = plant_id WHERE length(split_part(p_name, ' ', 1)) % 2 = 0")
def enhance_stats(spark, d):
    rows = ad.table(spark, d, "part").selectExpr("p_partkey AS source_row", "p_name AS name")
    some = matching.match_exact(rows, ad.entities(spark, d).filter("length(genus) % 2 = 0")).filter("plant_id is not null")
    m = some.select(F.lower("name").alias("name_key"), "plant_id", F.lit("EXACT").alias("match_type"), F.lit(1.0).alias("confidence"))
    mapped = _mapped(spark, d)
    return evidence.enhance_stats(evidence.enhance(mapped, rows, m, "parts", "b1"), mapped)


YEARS = "SELECT id, min(year(created_at)) AS y FROM w GROUP BY 1"


@register(sql(f"SELECT id_a, id_b, a.y AS year_a, b.y AS year_b, abs(a.y - b.y) AS gap, CASE WHEN a.y > b.y THEN 'a' WHEN b.y > a.y THEN 'b' END AS newer, abs(a.y - b.y) > 2 AS wide FROM pairs LEFT JOIN ({YEARS}) a ON a.id = id_a LEFT JOIN ({YEARS}) b ON b.id = id_b", *PAIRS))
def temporal_gap(spark, d):
    years = ad.warrants(spark, d).groupBy("id").agg(F.min(F.year("created_at")).cast("string").alias("year"))
    return evidence.temporal_gap(rg._pairs(spark, d), years, 2).select("id_a", "id_b", "year_a", "year_b", "gap", "newer", "wide")


@register(sql("SELECT id, CASE WHEN id IN (SELECT id FROM w WHERE warrant_type = 'external') THEN 'included' ELSE status END AS status FROM w", "w"))
def set_status(spark, d):
    w = ad.warrants(spark, d)
    return evidence.set_status(w, w.filter("warrant_type = 'external'"), "included", ("included", "excluded")).select("id", "status")


# Warrants of every seventh key are gone: pairs lose one side or both.
@register(sql("SELECT 'warrants' AS \"check\", count(*) AS n FROM k UNION ALL SELECT 'null_id', count_if(id IS NULL) FROM k UNION ALL SELECT 'null_plant_id', count_if(plant_id IS NULL) FROM k UNION ALL SELECT 'null_attribute_id', count_if(attribute_id IS NULL) FROM k UNION ALL SELECT 'orphan_conflicts', count(*) FROM x WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = x.warrant_a_id) OR NOT EXISTS (SELECT 1 FROM k WHERE k.id = x.warrant_b_id) UNION ALL SELECT 'conflict_type_' || conflict_type, count(*) FROM x GROUP BY conflict_type UNION ALL SELECT 'severity_' || severity, count(*) FROM x GROUP BY severity", *CONFLICTS).replace(" SELECT 'warrants'", ", k AS (SELECT * FROM w WHERE length(id) % 7 <> 0) SELECT 'warrants'", 1))
def verify_run(spark, d):
    x = rg._conflicts(spark, d).withColumnsRenamed({"warrant_a_id": "id_a", "warrant_b_id": "id_b"})
    return cl.verify_run(ad.warrants(spark, d).filter("length(id) % 7 <> 0"), x)


# Reports.


@register(sql("SELECT plant_id, concat('attribute ', CAST(attribute_id AS STRING)) AS attribute_name, count(*) AS n, max(CASE severity WHEN 'critical' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END) AS max_severity, attribute_id FROM x GROUP BY plant_id, attribute_id", *CONFLICTS))
def conflict_attributes(spark, d):
    named = lambda df: df.withColumn("attribute_name", F.concat(F.lit("attribute "), F.col("attribute_id").cast("string")))
    return reports.conflict_attributes(named(rg._conflicts(spark, d)), named(ad.warrants(spark, d)))


@register(sql("SELECT l.plant_id, l.attribute_id, l.id, warrants, current_value, conflict_ids FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY created_at DESC, id DESC) AS r FROM c) l LEFT JOIN (SELECT plant_id, attribute_id, string_agg(concat_ws(':', source_id, id, value), '; ' ORDER BY source_id NULLS FIRST, id, value) AS warrants, string_agg(DISTINCT value, ', ' ORDER BY value) AS current_value FROM w GROUP BY 1, 2) v USING (plant_id, attribute_id) LEFT JOIN (SELECT plant_id, attribute_id, string_agg(id, '; ' ORDER BY id) AS conflict_ids FROM x GROUP BY 1, 2) y USING (plant_id, attribute_id) WHERE r = 1", "c", *CONFLICTS))
def claim_view(spark, d):
    v = reports.claim_view(ad.claims(spark, d), ad.warrants(spark, d), ad.values(spark, d), rg._conflicts(spark, d))
    shown = F.array_join(F.transform("warrants", lambda w: F.concat_ws(":", w["source_id"], w["id"], w["value"])), "; ")
    return v.select("plant_id", "attribute_id", "id", shown.alias("warrants"), "current_value", F.array_join("conflict_ids", "; ").alias("conflict_ids"))


@register(sql("WITHX SELECT coalesce(a.plant_id, b.plant_id, k.plant_id) AS plant_id, warrants, open_conflicts, pending_claims, coalesce(n_approved, 0) AS n_approved FROM (SELECT plant_id, string_agg(concat(CAST(attribute_id AS STRING), ':', CAST(n AS STRING)), ', ' ORDER BY CAST(attribute_id AS STRING)) AS warrants FROM (SELECT plant_id, attribute_id, count(*) AS n FROM w WHERE status <> 'excluded' GROUP BY 1, 2) GROUP BY 1) a FULL JOIN (SELECT plant_id, string_agg(concat(attribute_name, ':', CAST(n AS STRING)), ', ' ORDER BY attribute_name) AS open_conflicts FROM (SELECT plant_id, attribute_name, count(*) AS n FROM x WHERE status NOT IN ('resolved', 'dismissed') GROUP BY 1, 2) GROUP BY 1) b ON a.plant_id = b.plant_id FULL JOIN (SELECT plant_id, string_agg(concat(CAST(attribute_id AS STRING), ':', status), ', ' ORDER BY CAST(attribute_id AS STRING)) AS pending_claims, CAST(sum(approved) AS BIGINT) AS n_approved FROM (SELECT plant_id, attribute_id, arg_max(status, struct_pack(created_at, id)) AS status, count_if(status = 'approved') AS approved FROM c WHERE status <> 'pushed' GROUP BY 1, 2) GROUP BY 1) k ON k.plant_id = coalesce(a.plant_id, b.plant_id)", "c", *CONFLICTS).replace("WITHX ", ""))
def curation_overlay(spark, d):
    out = reports.curation_overlay(ad.warrants(spark, d), rg._conflicts(spark, d), ad.claims(spark, d))
    flat = [F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ", ").alias(c) for c in ("warrants", "open_conflicts", "pending_claims")]
    return out.select("plant_id", *flat, "n_approved")


@register("WITH s AS (SELECT unnest(['matching', 'mapping', 'enhancing', 'classifying', 'committing']) AS step) SELECT CAST(event_id AS STRING) AS id, CASE WHEN event_id % 3 = 0 THEN 'mapping' ELSE 'pending' END AS current_step, step, CASE WHEN event_id % 3 = 0 AND step IN ('matching', 'mapping') THEN CASE step WHEN 'matching' THEN 'complete' ELSE event_type END ELSE 'pending' END AS state, CASE WHEN event_id % 3 = 0 AND step = 'mapping' THEN CAST(user_id AS STRING) END AS detail FROM events CROSS JOIN s")
def batch_progress(spark, d):
    notes = """CASE WHEN event_id % 3 = 0 THEN concat('{"currentStep": "mapping", "steps": {"matching": {"status": "complete"}, "mapping": {"status": "', event_type, '", "detail": "', user_id, '"}}}') WHEN event_id % 3 = 1 THEN 'broken' ELSE props END AS notes"""
    return reports.batch_progress(ad.table(spark, d, "events").selectExpr("CAST(event_id AS STRING) AS id", notes))


@register("SELECT CAST(user_id AS STRING) AS taxon_name, event_type AS var_name, round(avg(CAST(floor(value) AS BIGINT)) + 1e-9::DOUBLE, 2) AS mean, count(*) AS n FROM events WHERE event_id % 7 <> 0 AND value IS NOT NULL GROUP BY 1, 2")
def trait_means(spark, d):
    return reports.trait_means(ad.table(spark, d, "events").selectExpr("CAST(user_id AS STRING) AS taxon_name", "event_type AS var_name", "CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS var_value"))


@register("WITH l AS (SELECT p_brand AS dataset, CAST(p_size AS STRING) AS value FROM part) SELECT dataset, 'size' AS \"column\", CAST(sum(k) AS BIGINT) AS n, string_agg(CASE WHEN r <= 5 THEN value END, ', ' ORDER BY value) AS samples FROM (SELECT dataset, value, count(*) AS k, row_number() OVER (PARTITION BY dataset ORDER BY value) AS r FROM l GROUP BY 1, 2) GROUP BY 1")
def unmapped_columns(spark, d):
    p = ad.table(spark, d, "part")
    long = p.selectExpr("p_brand AS dataset", "stack(2, 'size', CAST(p_size AS STRING), 'type', p_type) AS (column, value)")
    known = spark.createDataFrame([("TYPE", "kind")], "column string, attribute_name string")
    return reports.unmapped_columns(long, known).withColumn("samples", F.array_join("samples", ", "))


@register("SELECT p_name AS name, p_type AS trait, count(DISTINCT p_brand) AS n_sources, count(DISTINCT p_size) AS n_values, count(DISTINCT p_size) = 1 AS agreed FROM part GROUP BY 1, 2")
def agreement(spark, d):
    return reports.agreement(ad.table(spark, d, "part").selectExpr("p_name AS name", "p_type AS trait", "CAST(p_size AS STRING) AS value", "p_brand AS source_id"))


WIDE = ["S1", "S2", "S3"]


@register(sql("SELECT source_a, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN source_b = '{s}' THEN n END), 0) AS BIGINT) AS {s}" for s in WIDE) + " FROM (SELECT source_a, source_b, n FROM g UNION ALL SELECT source_b, source_a, n FROM g WHERE source_a <> source_b) GROUP BY 1", *CONFLICTS).replace(" SELECT source_a, CAST", ", g AS (SELECT source_a, source_b, count(*) AS n FROM x GROUP BY 1, 2) SELECT source_a, CAST", 1))
def conflict_matrix_wide(spark, d):
    return reports.conflict_matrix_wide(reports.conflict_matrix(rg._conflicts(spark, d)), WIDE)


# Reliability, claims, snapshots.


METADATA = [
    "CASE plant_id % 7 WHEN 0 THEN 'Burn TEST' WHEN 1 THEN 'field notes' WHEN 2 THEN 'A review of literature' WHEN 3 THEN 'simulation' WHEN 4 THEN 'grower guide' WHEN 5 THEN 'meta analysis' ELSE 'hearsay' END AS source_methodology",
    "CASE plant_id % 6 WHEN 0 THEN 'Western Oregon' WHEN 1 THEN 'Oregon and Idaho' WHEN 2 THEN 'Australia' WHEN 3 THEN 'Global' WHEN 4 THEN 'Somewhere' ELSE '' END AS source_region",
    "CASE plant_id % 5 WHEN 0 THEN '2021-05' WHEN 1 THEN '2015' WHEN 2 THEN '1990' WHEN 3 THEN 'n.d.' END AS source_year",
]


# "Australia" holds "us" and is national by the fixed rule; all parts in hundredths.
@register(sql("SELECT source_id, floor((30 * [90, 70, 60, 50, 40, 100, 50][plant_id % 7 + 1] + 20 * 30 + 15 * 50 + 20 * [100, 80, 50, 30, 80, 50][plant_id % 6 + 1] + 15 * [100, 70, 40, 50, 50][plant_id % 5 + 1] + 50) / 100)::DOUBLE / 100 AS reliability_score FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY created_at DESC, id DESC) AS r FROM w WHERE source_id IS NOT NULL) WHERE r = 1 AND source_id NOT IN (SELECT id FROM s WHERE id LIKE '%7')", "w", "s"))
def seed_reliability(spark, d):
    w = ad.warrants(spark, d).selectExpr("*", *METADATA)
    return cl.seed_reliability(w, ad.sources(spark, d).filter("id like '%7'").selectExpr("id AS source_id"), 2026).select("source_id", "reliability_score")


@register(f"WITH k AS ({rg.ORACLES['consensus_claims']}), w AS ({ad.CTE['w']}) SELECT sha256(concat_ws('|', CAST(k.plant_id AS STRING), CAST(k.attribute_id AS STRING), k.value)) AS claim_id, w.id AS warrant_id, CASE WHEN lower(trim(w.value)) = k.value THEN 'primary' ELSE 'contextual' END AS inclusion_reason FROM w JOIN k USING (plant_id, attribute_id) WHERE w.status <> 'excluded'")
def claim_warrants(spark, d):
    return cl.build_claims(rg.QUERIES["consensus_claims"](spark, d), ad.warrants(spark, d))[1]


@register(f"SELECT id, new_value FROM ({rg.ORACLES['sync_preview']}) WHERE NOT is_stale")
def push_set(spark, d):
    return cl.push_set(cl.sync_preview(ad.claims(spark, d), ad.values(spark, d), ad.warrants(spark, d))).select("id", "new_value")


@register(f"WITH k AS (SELECT id FROM ({rg.ORACLES['sync_preview']}) WHERE NOT is_stale), c AS ({ad.CTE['c']}) SELECT id, CASE WHEN id IN (SELECT id FROM k) THEN 'pushed' ELSE status END AS status, id IN (SELECT id FROM k) AS pushed_to_production FROM c")
def mark_pushed(spark, d):
    return cl.mark_pushed(ad.claims(spark, d), push_set(spark, d)).select("id", "status", "pushed_to_production")


@register(f"SELECT 'b1' AS id, 'production' AS source_dataset, 'SYNC' AS source_id_code, 'production_sync' AS batch_type, 'completed' AS status, count(DISTINCT id) AS claims_generated, 'Pushed ' || count(DISTINCT id) || ' claim(s) to production' AS notes, CAST(NULL AS VARCHAR) AS dolt_commit_hash FROM ({rg.ORACLES['sync_preview']}) WHERE NOT is_stale HAVING count(*) > 0")
def batch_record(spark, d):
    return cl.batch_record(push_set(spark, d), "b1")


@register(sql("SELECT id, severity, (SELECT count(*) FROM x) AS total FROM x ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'moderate' THEN 1 WHEN 'minor' THEN 2 ELSE 3 END, id LIMIT 50 OFFSET 50", *CONFLICTS))
def conflict_page(spark, d):
    rows, total = reports.page(rg._conflicts(spark, d), "severity", 2, allowed=("severity", "conflict_type", "status"))
    return rows.select("id", "severity").withColumn("total", total.scalar())


@register("SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS parent FROM events")
def snapshot_log(spark, d):
    return cl.snapshot_log(ad.table(spark, d, "events").selectExpr("user_id AS table", "event_id AS snapshot_id", "ts AS committed_at")).selectExpr("table AS user_id", "snapshot_id AS event_id", "parent")


# Sources and dataset building.


def _profile_sql(c):
    return f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM part) AS n_rows, (SELECT count(*) FROM part WHERE trim(CAST({c} AS STRING)) <> '') AS n_filled, (SELECT string_agg(v, ', ' ORDER BY r) FROM (SELECT CAST({c} AS STRING) AS v, row_number() OVER (ORDER BY min(p_partkey), CAST({c} AS STRING)) AS r FROM part GROUP BY 1) WHERE r <= 20) AS \"values\""


@register(" UNION ALL ".join(_profile_sql(c) for c in ("p_name", "p_brand", "p_type", "p_size")))
def profile_source(spark, d):
    return tables.profile_source(ad.table(spark, d, "part").drop("p_retailprice"), 20, "p_partkey").withColumn("values", F.array_join("values", ", "))


@register("SELECT 'nation' AS \"table\", count(*) AS n_rows, 'n_nationkey, n_name, n_regionkey' AS columns, (SELECT string_agg(j, '; ' ORDER BY j) FROM (SELECT concat('{\"n_nationkey\":', CAST(n_nationkey AS STRING), ',\"n_name\":\"', n_name, '\",\"n_regionkey\":', CAST(n_regionkey AS STRING), '}') AS j FROM nation)) AS rows FROM nation UNION ALL SELECT 'part', count(*), 'p_partkey, p_name, p_brand, p_type, p_size, p_retailprice', (SELECT string_agg(j, '; ' ORDER BY j) FROM (SELECT to_json(p)::VARCHAR AS j FROM part p WHERE (SELECT count(*) FROM part) <= 200)) FROM part")
def catalog_summary(spark, d):
    out = tables.catalog_summary({n: ad.table(spark, d, n) for n in ("nation", "part")})
    return out.select("table", "n_rows", F.array_join("columns", ", ").alias("columns"), F.array_join("rows", "; ").alias("rows"))


@register("SELECT category, concat(prefix, '-', lpad(CAST(max(n) + 1 AS STRING), CAST(greatest(2, length(CAST(max(n) + 1 AS STRING))) AS INTEGER), '0')) AS next_id FROM (SELECT ['pollinators', 'traits', 'shade'][s_suppkey % 3 + 1] AS category, ['POLL', 'TRAIT', 'SHADE'][s_suppkey % 3 + 1] AS prefix, s_suppkey AS n FROM supplier) GROUP BY category, prefix")
def next_source_id(spark, d):
    s = ad.table(spark, d, "supplier").selectExpr("element_at(array('pollinators', 'traits', 'shade'), CAST(s_suppkey % 3 AS INT) + 1) AS category", "s_suppkey AS n")
    return tables.next_source_id(s.selectExpr("category", "concat('X-', CAST(n AS STRING)) AS source_id"))


@register("SELECT p_partkey, p_name, p_size FROM part ORDER BY p_partkey LIMIT 10")
def first_rows(spark, d):
    return tables.first_rows(ad.table(spark, d, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")


@register("SELECT p_partkey, CAST(i AS INT) AS region, p_size + i AS use, p_size * i AS et0 FROM part, unnest(range(1, 7)) t(i)")
def unpivot_regions(spark, d):
    wide = ad.table(spark, d, "part").select("p_partkey", *[x for i in range(1, 7) for x in ((F.col("p_size") + i).cast("long").alias(f"region_{i}_use"), (F.col("p_size") * i).cast("long").alias(f"region_{i}_et0"))])
    return harvest.unpivot_regions(wide, ["p_partkey"], 6, ["use", "et0"])


@register("SELECT p_partkey, 'words' AS attribute, unnest(string_split(p_name, ' ')) AS value FROM part UNION ALL SELECT p_partkey, 'brand', unnest(string_split(p_brand, '#')) FROM part")
def explode_lists(spark, d):
    return harvest.explode_lists(ad.table(spark, d, "part").selectExpr("p_partkey", "replace(p_name, ' ', ' | ') AS words", "replace(p_brand, '#', ' | ') AS brand"), "p_partkey", ["words", "brand"])


@register("WITH s AS (SELECT c_mktsegment AS symbol, n_name AS state, min(c_custkey) AS k FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2) SELECT symbol, string_agg(state, ', ' ORDER BY k) AS states, (SELECT c_name FROM customer WHERE c_custkey = min(k)) AS name FROM s GROUP BY 1")
def merge_states(spark, d):
    c = ad.table(spark, d, "customer").join(ad.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_mktsegment AS symbol", "n_name AS state", "c_custkey AS source_row", "c_name AS name")
    return harvest.merge_states(c).select("symbol", F.array_join("states", ", ").alias("states"), "name")


LINES = ["conv_id AS doc", "turn AS line_no", "concat(role, ': ', coalesce(text, '')) AS line"]


@register(f"WITH l AS (SELECT {', '.join(LINES)} FROM conversations) SELECT doc, line_no, line, header FROM (SELECT *, last_value(CASE WHEN starts_with(line, 'user: ') THEN trim(line) END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM l) WHERE NOT starts_with(line, 'user: ')")
def ffill_headers(spark, d):
    return harvest.ffill_headers(ad.table(spark, d, "conversations").selectExpr(*LINES), "^user: ").select("doc", "line_no", "line", "header")


@register(f"WITH l AS (SELECT {', '.join(LINES)} FROM conversations) SELECT doc, min(line_no) AS line_no, string_agg(trim(line), ' ' ORDER BY line_no) AS line FROM (SELECT *, sum(CASE WHEN starts_with(line, 'user: ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY line_no) AS g FROM l) GROUP BY doc, g")
def join_continuations(spark, d):
    return harvest.join_continuations(ad.table(spark, d, "conversations").selectExpr(*LINES), "^user: ")


@register(f"SELECT page_id, 'link' AS label, regexp_extract(text, 'The ([a-z]+)', 1) AS value FROM ({rg.ORACLES['page_text']}) WHERE regexp_extract(text, 'The ([a-z]+)', 1) NOT IN ('', 'none', 'n/a')")
def extract_labels(spark, d):
    return harvest.extract_labels(ad.table(spark, d, "pages"), "page_id", "html", {"link": "The ([a-z]+)"})


TRAIT_TEXT = "concat('Height: ', CAST(p_size AS STRING), '-', CAST(p_size + 2 AS STRING), ' feet. Spread: 1.5 foot', chr(10), 'HEIGHT:9 inches', chr(10), 'USDA hardiness zones: ', CAST(p_size % 9 + 1 AS STRING), chr(10), CASE WHEN p_size % 5 = 0 THEN 'M: moderate; an Invasive weed' WHEN p_size % 5 = 1 THEN 'L needs low water, native to Oregon' WHEN p_size % 5 = 2 THEN 'Native to western parts' ELSE p_name END, chr(10), 'Flowers: ', p_type, chr(10), 'Bloom time: May to June') AS text"


@register("SELECT p_partkey, concat(CAST(p_size AS STRING), '-', CAST(p_size + 2 AS STRING), ' feet|9 inches') AS heights, '1.5 foot' AS spreads, CAST(p_size % 9 + 1 AS STRING) AS zones, p_type AS flowers, 'May to June' AS blooms, CASE p_size % 5 WHEN 0 THEN 'Moderate' WHEN 1 THEN 'Low' ELSE '' END AS water_use, p_size % 5 = 0 AS invasive_warning, p_size % 5 IN (1, 2) AS native_hint FROM part")
def extract_traits(spark, d):
    out = harvest.extract_traits(ad.table(spark, d, "part").selectExpr("p_partkey", TRAIT_TEXT), "p_partkey", "text")
    return out.select("p_partkey", *[F.array_join(c, "|").alias(c) for c in harvest.TRAITS], "water_use", "invasive_warning", "native_hint")


PAYLOAD = "concat('{\"id\":', CAST(p_partkey AS STRING), ',\"scientific_name\":\"', p_name, '\",\"edible\":', CASE p_size % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'null' END, ',\"flower\":{\"color\":[\"Dark red\",\"rose\",\"', p_type, '\"]},\"foliage\":{\"leaf_retention\":', CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END, '},\"specifications\":{\"growth_habit\":[\"Subshrub\",\"', CASE WHEN p_size % 4 = 0 THEN 'Tree' ELSE 'Graminoids' END, '\"]},\"distribution\":{\"native\":[\"S. Oregon\",\"Nevada\"]}}') AS json"


@register("WITH e AS (SELECT lower(p_name) AS k, min(p_partkey) AS plant_id FROM part GROUP BY 1), j AS (SELECT plant_id, p_size, p_type FROM part JOIN e ON k = lower(p_name)) SELECT plant_id, 'Native Status' AS attribute, 'oregon' AS value, 'Native to: S. Oregon, Nevada' AS source_value FROM j UNION ALL SELECT plant_id, 'Edible Plant', CASE p_size % 3 WHEN 0 THEN 'true' ELSE 'false' END, CASE p_size % 3 WHEN 0 THEN 'edible: true' ELSE 'edible: false' END FROM j WHERE p_size % 3 <> 2 UNION ALL SELECT plant_id, CASE WHEN p_size % 4 = 0 THEN 'Tree' ELSE 'Graminoid' END, 'true', concat('growth_habit: Subshrub, ', CASE WHEN p_size % 4 = 0 THEN 'Tree' ELSE 'Graminoids' END) FROM j UNION ALL SELECT plant_id, 'Groundcover', 'true', concat('growth_habit: Subshrub, ', CASE WHEN p_size % 4 = 0 THEN 'Tree' ELSE 'Graminoids' END) FROM j UNION ALL SELECT plant_id, 'Evergreen', 'true', 'leaf_retention: true' FROM j WHERE p_size % 2 = 0 UNION ALL SELECT plant_id, 'Flower Color', '04', concat('flower.color: Dark red, rose, ', p_type) FROM j")
def species_to_warrants(spark, d):
    e = ad.entities(spark, d).groupBy("genus", "species").agg(F.min("id").alias("id"))
    return harvest.species_to_warrants(ad.table(spark, d, "part").selectExpr(PAYLOAD), e).drop("attribute_id")


REFS = ["doc_id AS ref_number", "text AS title", "concat(coalesce(lang, ''), ', A.') AS author", "source AS publisher", "doc_id % 2 AS list_no", "CASE WHEN doc_id % 7 = 0 THEN 'Yes' END AS have_it", "CASE doc_id % 5 WHEN 0 THEN 'trait_code' WHEN 1 THEN 'dataset' END AS type", "CASE WHEN doc_id % 3 = 0 THEN 'n.d.' ELSE CAST(2000 + doc_id % 20 AS STRING) END AS year"]


@register(f"WITH r AS (SELECT {', '.join(REFS)} FROM documents), k AS (SELECT *, nullif(trim(CASE WHEN trim(lower(coalesce(title, ''))) <> '' THEN concat(substring(trim(lower(title)), 1, 30), '|', substring(lower(coalesce(author, '')), 1, 20)) END), '') AS key FROM r) SELECT list_no, ref_number FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY list_no, ref_number) AS o FROM k) WHERE o = 1 OR key IS NULL")
def build_references(spark, d):
    r = ad.table(spark, d, "documents").selectExpr(*REFS)
    return harvest.build_references([r.filter("list_no = 0"), r.filter("list_no = 1")]).select("list_no", "ref_number")


_coded = lambda t: f"replace(replace(replace(url_encode({t}), '%20', '+'), '%2A', '*'), '~', '%7E')"
TRIAGE_SQL = f"WITH r AS (SELECT {', '.join(REFS)} FROM documents), k AS (SELECT *, lower(concat(' ', coalesce(title, ''), ' ', coalesce(publisher, ''))) AS t, left(concat_ws(' ', nullif(trim(split_part(author, ',', 1)), '@'), nullif(title, ''), CASE WHEN year <> 'n.d.' THEN year END), 200) AS q, have_it IS NOT NULL AS have FROM r)"


@register(f"{TRIAGE_SQL} SELECT ref_number, CASE WHEN have THEN 'HAVE_IT' WHEN regexp_matches(t, 'journal|proceedings|thesis|university|usda|forest service|extension|bulletin|research|study|doi') THEN 'LIKELY_ONLINE' WHEN regexp_matches(t, 'book|press|publishing|macmillan|claremont') THEN 'CHECK_LIBRARIES' WHEN regexp_matches(t, 'sunset|magazine|grounds maintenance') THEN 'CHECK_ARCHIVES' WHEN regexp_matches(t, 'department|city of|county|fire|state|california|forestry') THEN 'LIKELY_ONLINE' WHEN regexp_matches(t, 'nursery|garden|protect your|homeowner|green belt') THEN 'NEEDS_OUTREACH' WHEN type = 'trait_code' THEN 'LOW_PRIORITY' WHEN type = 'dataset' THEN 'HAVE_IT' ELSE 'TRY_ONLINE' END AS triage, CASE WHEN have THEN '' ELSE 'https://scholar.google.com/scholar?q=' || {_coded('q')} END AS google_scholar_url, CASE WHEN have THEN '' ELSE 'https://search.worldcat.org/search?q=' || {_coded('q')} END AS worldcat_url, CASE WHEN have THEN '' ELSE 'https://www.google.com/search?q=' || {_coded('q')} || '+filetype%3Apdf' END AS google_search_url, CASE WHEN have OR coalesce(title, '') = '' THEN '' ELSE 'https://web.archive.org/web/*/' || {_coded('left(title, 80)')} END AS wayback_url FROM k")
def triage_refs(spark, d):
    return harvest.triage_refs(ad.table(spark, d, "documents").selectExpr(*REFS)).select("ref_number", "triage", "google_scholar_url", "worldcat_url", "google_search_url", "wayback_url")


@register("SELECT p_name, min(p_partkey) AS p_partkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS categories FROM part GROUP BY 1")
def unique_with_sets(spark, d):
    return harvest.unique_with_sets(ad.table(spark, d, "part").select("p_name", "p_brand", "p_partkey"), "p_name", "p_brand", "p_partkey").withColumn("categories", F.array_join("categories", ", "))


# Document index.


def _nodes(spark, d):
    """Trees of up to 50 customers under one root."""
    c = ad.table(spark, d, "customer").withColumn("doc", F.floor(F.col("c_custkey") / 50))
    leaf = F.struct(F.col("c_name").alias("title"), F.col("c_custkey").cast("string").alias("node_id"), F.col("c_custkey").alias("start_index"))
    docs = c.groupBy("doc").agg(F.to_json(F.array(F.struct(F.lit("root").alias("title"), F.concat(F.lit("r"), F.col("doc").cast("string")).alias("node_id"), F.collect_list(leaf).alias("nodes")))).alias("structure"))
    return docindex.flatten_nodes(docs.select(F.concat(F.lit("d"), F.col("doc").cast("string")).alias("doc_name"), "structure"))


NODES_SQL = "SELECT concat('d', CAST(c_custkey // 50 AS STRING)) AS doc_name, CAST(c_custkey AS STRING) AS node_id, concat('r', CAST(c_custkey // 50 AS STRING)) AS parent_id, 1 AS depth, c_name AS title, c_custkey AS start_index FROM customer UNION ALL SELECT DISTINCT concat('d', CAST(c_custkey // 50 AS STRING)), concat('r', CAST(c_custkey // 50 AS STRING)), NULL, 0, 'root', NULL::BIGINT FROM customer"


@register(NODES_SQL)
def flatten_nodes(spark, d):
    return _nodes(spark, d).select("doc_name", "node_id", "parent_id", "depth", "title", "start_index")


@register(f"WITH k AS ({NODES_SQL}), m AS (SELECT doc_name, count_if(parent_id IS NULL) AS n_roots, count(*) AS n_nodes FROM k GROUP BY 1) SELECT DISTINCT n.doc_id, m.n_roots, coalesce(m.n_nodes, 0) AS n_nodes, m.n_nodes IS NOT NULL AS indexed FROM (SELECT concat('d', CAST(p_partkey // 10 AS STRING)) AS doc_id FROM part) n LEFT JOIN m ON m.doc_name = n.doc_id")
def index_status(spark, d):
    docs = ad.table(spark, d, "part").select(F.concat(F.lit("d"), F.floor(F.col("p_partkey") / 10).cast("string")).alias("doc_id")).distinct()
    return docindex.index_status(docs, docindex.manifest(_nodes(spark, d).withColumnRenamed("doc_name", "doc_id")))


TOC = ["conv_id AS doc_id", "CASE WHEN turn % 2 = 0 THEN CAST(CAST(floor(turn / 2) AS BIGINT) + 1 AS STRING) ELSE concat(CAST(CAST(floor(turn / 2) AS BIGINT) + 1 AS STRING), '.1') END AS code", "role AS title", "turn * 2 + 2 AS page", "turn % 3 = 0 AS starts_page"]


@register(f"WITH t AS (SELECT *, lead(page) OVER v AS np, lead(starts_page) OVER v AS ns, row_number() OVER v AS rn FROM (SELECT {', '.join(TOC)} FROM conversations) WINDOW v AS (PARTITION BY doc_id ORDER BY page)) SELECT doc_id, code, title, page AS start_page, CASE WHEN np IS NULL THEN 99 ELSE greatest(page, np - CASE WHEN ns THEN 1 ELSE 0 END) END AS end_page, CASE WHEN code LIKE '%.%' THEN split_part(code, '.', 1) END AS parent_code FROM t UNION ALL SELECT doc_id, '0', 'Preface', 1, page - 1, NULL FROM t WHERE rn = 1 AND page > 1")
def outline(spark, d):
    toc = ad.table(spark, d, "conversations").selectExpr(*TOC)
    return docindex.outline(toc, toc.select("doc_id").distinct().withColumn("pages", F.lit(99).cast("long")))


@register("WITH p AS (SELECT conv_id AS doc_id, length(text) % 3 AS k, count(*) AS n, min(turn) AS seen FROM conversations WHERE text IS NOT NULL GROUP BY 1, 2) SELECT doc_id, k AS \"offset\" FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, seen) AS r FROM p) WHERE r = 1")
def page_offset(spark, d):
    return docindex.page_offset(ad.table(spark, d, "conversations").selectExpr("conv_id AS doc_id", "turn AS seq", "turn + length(text) % 3 AS physical", "turn AS printed"))


@register("SELECT conv_id AS doc_id, '1' AS code, count(*) AS n_pages, CAST(sum(length(text) // 4) AS BIGINT) AS tokens FROM conversations WHERE turn >= 0 GROUP BY 1 HAVING count(*) > 2 AND sum(length(text) // 4) >= 100")
def large_nodes(spark, d):
    c = ad.table(spark, d, "conversations")
    nodes = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.max("turn").alias("end_page")).selectExpr("doc_id", "'1' AS code", "0 AS start_page", "end_page")
    return docindex.large_nodes(nodes, c.selectExpr("conv_id AS doc_id", "turn AS page", "text"), 2, 100)


@register(f"WITH n AS ({rg.NODES_SQL}), q AS (SELECT 1 AS query_id, unnest(['the', 'and', 'that']) AS word) SELECT query_id, doc_id, CAST(node_id AS BIGINT) AS node_id, n_terms, rank, left(summary, 500) AS summary FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n_terms DESC, doc_id, node_id) AS rank FROM (SELECT query_id, doc_id, node_id, min(summary) AS summary, count(*) AS n_terms FROM n JOIN q ON contains(lower(concat_ws(' ', title, summary)), word) GROUP BY 1, 2, 3 HAVING count(*) >= 2)) WHERE rank <= 10")
def search_terms(spark, d):
    return docindex.search_terms(rg._sections(spark, d), spark.createDataFrame([(1, "the and that of")], "query_id int, query string")).select("query_id", "doc_id", "node_id", "n_terms", "rank", "summary")
