"""Registered queries over the given tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import claims as cl
from ..operators import docindex, eav, evidence, harvest, matching, reports
from ..sources.scratch import kept
from . import adapters as ad
from .adapters import sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
PAIRS = ("w", "m", "anchors", "pairs")
CONFLICTS = (*PAIRS, "x")


def register(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return evidence.conflict_pairs(evidence.warrant_group_members(ad.warrants(spark, d)))


def _conflicts(spark: SparkSession, d: str) -> DataFrame:
    """The chain of pairs, labels and conflicts; labels and states are made from the pairs' keys."""
    p = evidence.finalize_conflicts(evidence.classify_pairs(_pairs(spark, d)).drop("severity").selectExpr("*", *ad.LABELS))
    return p.selectExpr(*ad.STATES, *SIDES)


SIDES = ["plant_id", "attribute_id", "id_a AS warrant_a_id", "id_b AS warrant_b_id", "value_a", "value_b", "source_id_a AS source_a", "source_id_b AS source_b", "conflict_type", "severity", "specialist_agent"]


@register(sql("SELECT plant_id, attribute_id, count(*) AS n_warrants FROM w WHERE status <> 'excluded' GROUP BY 1, 2 HAVING count(*) >= 2", "w"))
def warrant_groups(spark, d):
    return evidence.warrant_groups(ad.warrants(spark, d))


@register(sql("SELECT w.plant_id, w.attribute_id, id, value FROM w JOIN (SELECT plant_id, attribute_id FROM w WHERE status <> 'excluded' AND warrant_type = 'external' GROUP BY 1, 2 HAVING count(*) >= 2) g USING (plant_id, attribute_id) WHERE status <> 'excluded'", "w"))
def warrant_group_members(spark, d):
    return evidence.warrant_group_members(ad.warrants(spark, d), "external").select("plant_id", "attribute_id", "id", "value")


@register(sql("SELECT * FROM pairs", *PAIRS))
def conflict_pairs(spark, d):
    return _pairs(spark, d)


@register(sql("SELECT id_a, id_b, CASE WHEN value_a = value_b THEN 'corroborated' WHEN value_a = 'unknown' OR value_b = 'unknown' THEN 'COMPLETENESS_CONFLICT' ELSE 'REVIEW' END AS verdict, CASE WHEN value_a <> value_b AND 'unknown' IN (value_a, value_b) THEN 'minor' END AS severity FROM pairs", *PAIRS))
def classify_pairs(spark, d):
    return evidence.classify_pairs(_pairs(spark, d)).select("id_a", "id_b", "verdict", "severity")


@register(sql("SELECT * FROM x", *CONFLICTS))
def finalize_conflicts(spark, d):
    p = evidence.classify_pairs(_pairs(spark, d)).drop("severity")
    labels = p.selectExpr("id_a", "id_b", *ad.LABELS).distinct()
    return evidence.finalize_conflicts(p, labels).selectExpr(*ad.STATES, *SIDES)


@register(sql("SELECT source_a, source_b, count(*) AS n, count_if(severity = 'critical') AS n_critical, count_if(severity = 'moderate') AS n_moderate, count_if(severity = 'minor') AS n_minor, count_if(status = 'pending') AS n_pending, count_if(status = 'resolved' OR status = 'dismissed') AS n_resolved FROM x GROUP BY 1, 2", *CONFLICTS))
def conflict_matrix(spark, d):
    return reports.conflict_matrix(_conflicts(spark, d))


@register(sql("SELECT max(n) AS max_count FROM (SELECT count(*) AS n FROM x GROUP BY source_a, source_b)", *CONFLICTS))
def matrix_max(spark, d):
    return reports.matrix_max(reports.conflict_matrix(_conflicts(spark, d)))


@register(sql("SELECT 'total' AS dimension, 'all' AS key, count(*) AS n FROM x UNION ALL SELECT 'severity', severity, count(*) FROM x GROUP BY 2 UNION ALL SELECT 'type', conflict_type, count(*) FROM x GROUP BY 2", *CONFLICTS))
def conflict_summary(spark, d):
    return evidence.conflict_summary(_conflicts(spark, d))


@register(sql("SELECT source, count(*) AS n, count_if(severity = 'critical') AS n_critical, count_if(status = 'pending') AS n_pending, count_if(status NOT IN ('pending', 'annotated')) AS n_resolved, round(100.0 * count_if(status NOT IN ('pending', 'annotated')) / count(*), 1) AS resolution_rate FROM (SELECT source_a AS source, severity, status FROM x UNION ALL SELECT source_b, severity, status FROM x) WHERE source IS NOT NULL GROUP BY 1", *CONFLICTS))
def source_conflict_summary(spark, d):
    return reports.source_conflict_summary(_conflicts(spark, d))


@register(sql("SELECT conflict_type, severity, count(*) AS n FROM x WHERE (source_a = 'S1' AND source_b = 'S2') OR (source_a = 'S2' AND source_b = 'S1') GROUP BY 1, 2", *CONFLICTS))
def pair_breakdown(spark, d):
    return reports.pair_breakdown(_conflicts(spark, d), "S1", "S2")


@register(sql("SELECT least(source_a, source_b) AS source_1, greatest(source_a, source_b) AS source_2, count(*) AS n FROM x WHERE source_a IS NOT NULL AND source_b IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 10", *CONFLICTS))
def top_pairs(spark, d):
    return reports.top_pairs(_conflicts(spark, d), 10)


@register(sql("SELECT plant_id, count(*) AS n, CASE WHEN bool_or(severity = 'critical') THEN 'critical' WHEN bool_or(severity = 'moderate') THEN 'moderate' ELSE 'minor' END AS max_severity, count(DISTINCT attribute_name) AS n_attributes, count_if(status IN ('pending', 'annotated')) AS n_open, CASE WHEN NOT bool_or(status IN ('pending', 'annotated')) THEN 'complete' WHEN bool_or(status IN ('resolved', 'dismissed')) THEN 'in_progress' ELSE 'pending' END AS queue_status FROM x GROUP BY 1", *CONFLICTS))
def conflict_queue(spark, d):
    return reports.conflict_queue(_conflicts(spark, d))


@register(sql("SELECT 'status' AS option, status AS value FROM x UNION SELECT 'severity', severity FROM x UNION SELECT 'type', conflict_type FROM x UNION SELECT 'mode', conflict_mode FROM x UNION SELECT 'category', 'other' FROM x UNION SELECT 'source', source_a FROM x WHERE source_a IS NOT NULL UNION SELECT 'source', source_b FROM x WHERE source_b IS NOT NULL", *CONFLICTS))
def filter_options(spark, d):
    return reports.filter_options(_conflicts(spark, d))


@register(sql("SELECT plant_id, attribute_id, count(DISTINCT value) AS n_values, string_agg(DISTINCT value, ', ' ORDER BY value) AS value_list FROM w GROUP BY 1, 2 HAVING count(DISTINCT value) > 1", "w"))
def internal_conflicts(spark, d):
    return evidence.internal_conflicts(ad.values(spark, d))


@register(sql("SELECT id, plant_id, attribute_id, value FROM w JOIN (SELECT plant_id, attribute_id FROM w WHERE source_id IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT value) > 1 AND count(DISTINCT source_id) > 1) g USING (plant_id, attribute_id) WHERE source_id IS NOT NULL", "w"))
def audit_disagreements(spark, d):
    return evidence.audit_disagreements(ad.values(spark, d)).select("id", "plant_id", "attribute_id", "value")


def _audit_sql(body: str, known: bool = True) -> str:
    """``known``: groups and values of some entities and of one attribute are left out, as unknown ones."""
    group, entity, attribute = ("plant_id % 5 <> 0 AND attribute_id <> 7 AND ", " WHERE id % 5 <> 0", " AND attribute_id <> 7") if known else ("", "", "")
    return (
        f"WITH w AS ({ad.CTE['w']}), e AS ({ad.CTE['e']}), "
        f"g AS (SELECT plant_id, attribute_id FROM w WHERE {group}source_id IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT value) > 1 AND count(DISTINCT source_id) > 1), "
        "f AS (SELECT w.plant_id, w.attribute_id, w.value, w.source_id, 1 AS scan FROM w JOIN g ON g.plant_id = w.plant_id AND g.attribute_id = w.attribute_id WHERE source_id IS NOT NULL "
        "UNION ALL SELECT plant_id, attribute_id, value, source_id, 2 FROM w WHERE value NOT IN ('NO', 'AF') UNION ALL SELECT plant_id, attribute_id, value, NULL, 3 FROM w WHERE source_id IS NULL), "
        f"new AS (SELECT plant_id, attribute_id, value, scan, source_id FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id, value ORDER BY scan, source_id NULLS FIRST) AS r FROM f WHERE plant_id IN (SELECT id FROM e{entity}){attribute}) n "
        "WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM w k WHERE k.status = 'excluded' AND k.plant_id = n.plant_id AND k.attribute_id = n.attribute_id AND k.value = n.value)), "
        f"two AS (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY source_id, value) AS r FROM new WHERE scan = 1) {body}"
    )


def _audit(spark, d, entities, attributes):
    attrs = attributes.withColumn("values_allowed", F.lit('[{"id":"01","displayName":"no"},{"id":"AF"}]'))
    v = ad.values(spark, d).drop("attribute_name")
    return evidence.run_audit(v, attrs, v.filter("status = 'excluded'"), entities)


def _audited(spark, d):
    """All entities but some and all attributes but one, so that values of unknown ones are there to be left out."""
    return ad.entities(spark, d).filter("id % 5 <> 0"), ad.attributes(spark, d).filter("id <> 7")


@register(_audit_sql("SELECT plant_id, attribute_id, concat('attribute ', CAST(attribute_id AS STRING)) AS attribute_name, value, source_id, scan, CASE scan WHEN 2 THEN concat('Value validation failure: ', chr(34), value, chr(34), ' not in allowed set [no, af]') WHEN 3 THEN 'Missing provenance: value has no source_id' END AS notes FROM new"))
def run_audit(spark, d):
    return _audit(spark, d, *_audited(spark, d)).select("plant_id", "attribute_id", "attribute_name", "value", "source_id", "scan", "notes")


@register(_audit_sql("SELECT a.plant_id, a.attribute_id, a.value AS value_a, b.value AS value_b, a.source_id AS source_a, b.source_id AS source_b FROM two a JOIN two b USING (plant_id, attribute_id) WHERE a.r = 1 AND b.r = 2", known=False))
def audit_conflicts(spark, d):
    return evidence.audit_conflicts(_audit(spark, d, ad.entities(spark, d), ad.attributes(spark, d))).select("plant_id", "attribute_id", "value_a", "value_b", "source_a", "source_b")


@register(_audit_sql("SELECT (SELECT count(*) FROM g) AS disagreements_found, (SELECT count(*) FROM new WHERE scan = 2) AS validation_failures, (SELECT count(*) FROM new WHERE scan = 3) AS missing_provenance, (SELECT count(*) FROM new) AS warrants_created, (SELECT count(*) FROM two WHERE r = 2) AS conflicts_created"))
def audit_results(spark, d):
    known = _audited(spark, d)
    new = _audit(spark, d, *known)
    return evidence.audit_results(new, evidence.audit_conflicts(new), ad.values(spark, d), *known)


@register(sql("SELECT sha256(concat('existing|', w.id)) AS id, 'existing' AS warrant_type, 'unreviewed' AS status, 'b1' AS batch_id, w.plant_id, e.genus AS plant_genus, e.species AS plant_species, w.attribute_id, a.name AS attribute_name, w.value, w.value AS source_value, w.source_id, s.region AS source_region, s.name AS source_dataset, 'production' AS match_method, 1.0::DOUBLE AS match_confidence FROM w JOIN e ON w.plant_id = e.id JOIN a ON w.attribute_id = a.id LEFT JOIN s ON w.source_id = s.id", "w", "e", "a", "s"))
def bootstrap_warrants(spark, d):
    v = ad.values(spark, d).withColumn("source_value", F.col("value"))
    return evidence.bootstrap_warrants(v, ad.entities(spark, d), ad.attributes(spark, d), ad.sources(spark, d), "b1")


@register(sql("SELECT plant_id, attribute_id FROM (SELECT e.id AS plant_id, a.id AS attribute_id FROM e CROSS JOIN a) EXCEPT SELECT plant_id, attribute_id FROM w", "w", "e", "a"))
def gap_matrix(spark, d):
    return eav.gap_matrix(ad.entities(spark, d), ad.attributes(spark, d), ad.values(spark, d))


@register(sql("SELECT a.id AS attribute_id, a.name, 'attribute 1' AS category, count(DISTINCT w.plant_id) AS n_entities, (SELECT count(*) FROM e) AS total, floor(count(DISTINCT w.plant_id) / (SELECT count(*) FROM e)::DOUBLE * 1000 + 0.5) / 10 AS pct, (SELECT count(*) FROM e) - count(DISTINCT w.plant_id) AS gap FROM a LEFT JOIN w ON w.attribute_id = a.id WHERE a.id <> 1 GROUP BY 1, 2", "w", "e", "a"))
def attribute_coverage(spark, d):
    return eav.attribute_coverage(ad.entities(spark, d), ad.attributes(spark, d), ad.values(spark, d))


@register(sql("SELECT e.id AS plant_id, count(DISTINCT w.attribute_id) AS n_filled, floor(count(DISTINCT w.attribute_id) / 4.0::DOUBLE * 1000 + 0.5) / 10 AS pct FROM e LEFT JOIN w ON w.plant_id = e.id AND w.attribute_id IN (1, 2, 3, 4) GROUP BY 1", "w", "e"))
def entity_completeness(spark, d):
    return eav.entity_completeness(ad.entities(spark, d), ad.values(spark, d), [1, 2, 3, 4])


@register(sql("SELECT e.id, e.name, count(DISTINCT w.attribute_id) AS n_attributes, count(DISTINCT CASE WHEN w.attribute_id <= 3 THEN w.attribute_id END) AS n_keys FROM e LEFT JOIN w ON w.plant_id = e.id GROUP BY 1, 2", "w", "e"))
def entity_list(spark, d):
    return eav.entity_list(ad.entities(spark, d), ad.values(spark, d), [1, 2, 3]).select("id", "name", "n_attributes", "n_keys")


@register(sql("SELECT DISTINCT plant_id FROM w WHERE attribute_id = 1 AND value IN ('RF', 'AF')", "w"))
def entities_with(spark, d):
    return eav.entities_with(ad.values(spark, d), 1, ["RF", "AF"])


@register(sql("SELECT e.id FROM e WHERE e.id NOT IN (SELECT plant_id FROM w WHERE attribute_id = 7)", "w", "e"))
def gap_entities(spark, d):
    return eav.gap_entities(ad.entities(spark, d), ad.values(spark, d), 7).select("id")


PRESETS = [("fire", 1, "AF"), ("fire", 1, "RF"), ("fire", 2, "NO"), ("water", 3, "NO")]


@register(sql("SELECT 'fire' AS preset, plant_id FROM w GROUP BY plant_id HAVING count_if(attribute_id = 1 AND value IN ('AF', 'RF')) > 0 AND count_if(attribute_id = 2 AND value = 'NO') > 0 UNION ALL SELECT 'water', plant_id FROM w GROUP BY plant_id HAVING count_if(attribute_id = 3 AND value = 'NO') > 0", "w"))
def apply_presets(spark, d):
    return eav.apply_presets(ad.values(spark, d), spark.createDataFrame(PRESETS, "preset string, attribute_id long, value string"))


@register("WITH RECURSIVE t AS (" + ad.CTE["t"] + "), p AS (SELECT id, name, name AS root_name, name AS path, 1 AS level FROM t WHERE parent IS NULL UNION ALL SELECT t.id, t.name, p.root_name, concat(p.path, ' > ', t.name), p.level + 1 FROM t JOIN p ON t.parent = p.id) SELECT * FROM p")
def attribute_paths(spark, d):
    return eav.attribute_paths(ad.tree(spark, d))


@register(sql("SELECT t.id, t.name, u.name AS parent_name FROM t LEFT JOIN t u ON t.parent = u.id", "t"))
def attribute_parents(spark, d):
    return eav.attribute_parents(ad.tree(spark, d)).select("id", "name", "parent_name")


@register(sql("SELECT DISTINCT plant_id, attribute_id, source_id, s.name AS source_name FROM w JOIN s ON w.source_id = s.id", "w", "s"))
def source_attribution(spark, d):
    return eav.source_attribution(ad.values(spark, d), ad.sources(spark, d))


@register(sql("SELECT plant_id, " + ", ".join(f"coalesce(array_to_string(list_sort(list(DISTINCT value) FILTER (attribute_id = {i})), ', '), '') AS a{i}" for i in (1, 2, 3)) + " FROM w WHERE attribute_id IN (1, 2, 3) GROUP BY 1", "w"))
def pivot_entities(spark, d):
    p = eav.pivot_entities(ad.values(spark, d), [1, 2, 3])
    return p.select("plant_id", *[F.array_join(c, ", ").alias(c) for c in ("a1", "a2", "a3")])


@register(sql("SELECT plant_id, max(CASE WHEN attribute_id = 1 AND value = 'NO' THEN 1 ELSE 0 END) AS has_open, CAST(greatest(0, least(6, sum(CASE WHEN attribute_id = 2 AND value = 'NO' THEN 1 WHEN attribute_id = 2 AND value = 'RF' THEN 2 ELSE 0 END))) AS BIGINT) AS wildlife, CAST(greatest(-3, least(0, sum(CASE WHEN attribute_id = 3 AND value = 'AF' THEN -1 ELSE 0 END))) AS BIGINT) AS invasive, wildlife + invasive AS total FROM w GROUP BY 1", "w"))
def value_matrix(spark, d):
    return eav.value_matrix(ad.values(spark, d), {"open": (1, ["NO"])}, {"wildlife": (2, {"NO": 1, "RF": 2}, 0, 6), "invasive": (3, {"AF": -1}, -3, 0)})


@register(sql("SELECT plant_id, attribute_id, count(*) AS n_warrants, count_if(warrant_type = 'external') AS n_external FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.plant_id = w.plant_id AND c.attribute_id = w.attribute_id) GROUP BY 1, 2 HAVING count(*) >= 2 AND count_if(warrant_type = 'external') >= 1", "w", "c"))
def unsynthesized_pairs(spark, d):
    return reports.unsynthesized_pairs(ad.warrants(spark, d), ad.claims(spark, d))


@register(sql("SELECT c.id AS claim_id, count(*) AS n_later FROM c JOIN w USING (plant_id, attribute_id) WHERE c.status = 'approved' AND w.status <> 'excluded' AND w.created_at > c.approved_at GROUP BY 1", "w", "c"))
def stale_claims(spark, d):
    return cl.stale_claims(ad.claims(spark, d), ad.warrants(spark, d))


@register(sql("SELECT plant_id, attribute_id, string_agg(DISTINCT value, ', ' ORDER BY value) AS current_value FROM w WHERE EXISTS (SELECT 1 FROM c WHERE c.plant_id = w.plant_id AND c.attribute_id = w.attribute_id AND c.status = 'approved') GROUP BY 1, 2", "w", "c"))
def current_values(spark, d):
    return cl.current_values(ad.values(spark, d), cl.syncable_claims(ad.claims(spark, d)))


@register(sql("SELECT c.id, coalesce(edited_value, categorical_value, synthesized_text) AS new_value, v.current_value, z.n_later, z.n_later IS NOT NULL AS is_stale FROM c LEFT JOIN (SELECT plant_id, attribute_id, string_agg(DISTINCT value, ', ' ORDER BY value) AS current_value FROM w GROUP BY 1, 2) v USING (plant_id, attribute_id) LEFT JOIN (SELECT k.id, count(*) AS n_later FROM c k JOIN w USING (plant_id, attribute_id) WHERE k.status = 'approved' AND w.status <> 'excluded' AND w.created_at > k.approved_at GROUP BY 1) z ON z.id = c.id WHERE c.status = 'approved'", "w", "c"))
def sync_preview(spark, d):
    return cl.sync_preview(ad.claims(spark, d), ad.values(spark, d), ad.warrants(spark, d)).select("id", "new_value", "current_value", "n_later", "is_stale")


VALUES_ONCE = "SELECT id, plant_id, attribute_id, min(value) AS value FROM w GROUP BY 1, 2, 3"


def _values_once(spark, d):
    return ad.values(spark, d).groupBy("id", "plant_id", "attribute_id").agg(F.min("value").alias("value"))


UPSERT = f"v AS ({VALUES_ONCE}), l AS (SELECT plant_id, attribute_id, coalesce(edited_value, categorical_value, synthesized_text) AS new_value FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY approved_at DESC, id DESC) AS r FROM c WHERE status = 'approved') WHERE r = 1), f AS (SELECT plant_id, attribute_id, min(id) AS id FROM v GROUP BY 1, 2), u AS (SELECT v.id, v.plant_id, v.attribute_id, coalesce(l.new_value, v.value) AS value, CASE WHEN l.new_value IS NULL THEN 'kept' ELSE 'updated' END AS action FROM v LEFT JOIN f ON f.id = v.id AND f.plant_id = v.plant_id AND f.attribute_id = v.attribute_id LEFT JOIN l ON l.plant_id = f.plant_id AND l.attribute_id = f.attribute_id UNION ALL SELECT concat_ws('-', 'new', CAST(l.plant_id AS STRING), CAST(l.attribute_id AS STRING)), l.plant_id, l.attribute_id, l.new_value, 'inserted' FROM l WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.plant_id = l.plant_id AND f.attribute_id = l.attribute_id))"


@register(f"WITH w AS ({ad.CTE['w']}), c AS ({ad.CTE['c']}), {UPSERT} SELECT * FROM u")
def upsert_values(spark, d):
    return cl.upsert_values(_values_once(spark, d), cl.syncable_claims(ad.claims(spark, d)))


def _synced(spark, d, old):
    """The store after a sync that also loses the rows of one attribute and blanks the values of another."""
    new = cl.upsert_values(old, cl.syncable_claims(ad.claims(spark, d))).drop("action").filter("attribute_id <> 6 or id like 'new%'")
    return new.withColumn("value", F.when(F.col("attribute_id") != 5, F.col("value")))


def _snapshots(spark, d):
    """The store before and after the sync."""
    old = _values_once(spark, d)
    return old, _synced(spark, d, old)


SNAPSHOTS = f"WITH w AS ({ad.CTE['w']}), c AS ({ad.CTE['c']}), {UPSERT}, after AS (SELECT id, plant_id, attribute_id, CASE WHEN attribute_id <> 5 THEN value END AS value FROM u WHERE attribute_id <> 6 OR id LIKE 'new%')"


@register(f"{SNAPSHOTS} SELECT coalesce(v.id, n.id) AS id, CASE WHEN v.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'modified' END AS change, v.value AS old_value, n.value AS new_value FROM v FULL JOIN after n ON v.id = n.id WHERE v.id IS NULL OR n.id IS NULL OR v.value IS DISTINCT FROM n.value")
def snapshot_diff(spark, d):
    return cl.snapshot_diff(*_snapshots(spark, d), ["id"]).select("id", "change", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))


@register(f"{SNAPSHOTS} SELECT change, count(*) AS n FROM (SELECT CASE WHEN v.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'modified' END AS change FROM v FULL JOIN after n ON v.id = n.id WHERE v.id IS NULL OR n.id IS NULL OR v.value IS DISTINCT FROM n.value) GROUP BY 1")
def snapshot_summary(spark, d):
    return cl.snapshot_diff(*_snapshots(spark, d), ["id"]).groupBy("change").agg(F.count("*").alias("n"))


# After the sync the values of attribute 4 changed again: those rows stay, where the sync had touched them as conflicts.
@register(f"{SNAPSHOTS}, now AS (SELECT id, plant_id, attribute_id, CASE WHEN attribute_id = 4 THEN 'later' ELSE value END AS value FROM after), touched AS (SELECT coalesce(v.id, n.id) AS id FROM v FULL JOIN after n ON v.id = n.id WHERE v.id IS NULL OR n.id IS NULL OR v.value IS DISTINCT FROM n.value) SELECT id, plant_id, attribute_id, value, FALSE AS conflict FROM v WHERE attribute_id <> 4 UNION ALL SELECT id, plant_id, attribute_id, value, id IN (SELECT id FROM touched) FROM now WHERE attribute_id = 4")
def revert(spark, d):
    old, new = _snapshots(spark, d)
    now = new.withColumn("value", F.when(F.col("attribute_id") == 4, "later").otherwise(F.col("value")))
    return cl.revert(now, cl.snapshot_diff(old, new, ["id"]), ["id"])


@register(sql("SELECT id, source_dataset, batch_type, started_at FROM (SELECT *, row_number() OVER (PARTITION BY source_dataset ORDER BY started_at DESC, id DESC) AS r FROM b) WHERE r = 1", "b"))
def latest_batch(spark, d):
    return reports.latest_batch(ad.batches(spark, d)).select("id", "source_dataset", "batch_type", "started_at")


@register(sql("SELECT id, status FROM b WHERE status = 'running' UNION ALL SELECT * FROM (SELECT id, status FROM b WHERE status <> 'running' ORDER BY started_at DESC, id DESC LIMIT 10)", "b"))
def batch_status(spark, d):
    return reports.batch_status(ad.batches(spark, d)).select("id", "status")


@register(sql("SELECT 'warrants' AS counter, '' AS key, count(*) AS n FROM w UNION ALL SELECT 'warrants_by_type', warrant_type, count(*) FROM w GROUP BY 2 UNION ALL SELECT 'conflicts', '', count(*) FROM x UNION ALL SELECT 'conflicts_by_severity', severity, count(*) FROM x GROUP BY 2 UNION ALL SELECT 'conflicts_pending', '', count_if(status = 'pending') FROM x UNION ALL SELECT 'conflicts_critical_pending', '', count_if(status = 'pending' AND severity = 'critical') FROM x UNION ALL SELECT 'internal_conflicts_pending', '', count_if(status = 'pending' AND conflict_mode = 'internal') FROM x UNION ALL SELECT 'claims', '', count(*) FROM c UNION ALL SELECT 'claims_by_status', status, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'claims_to_sync', '', count_if(status = 'approved') FROM c UNION ALL SELECT 'unreviewed_in_latest_batch', '', count(*) FROM w WHERE status = 'unreviewed' AND batch_id = (SELECT max(batch_id) FROM w) UNION ALL SELECT 'batches_completed', '', count(DISTINCT batch_id) FROM w WHERE CAST(batch_id AS INT) % 2 = 0", "c", *CONFLICTS))
def dashboard(spark, d):
    return reports.dashboard(ad.warrants(spark, d), _conflicts(spark, d), ad.claims(spark, d), ad.warrant_batches(spark, d))


@register(sql("SELECT plant_id, count(*) AS n_unreviewed FROM w WHERE status = 'unreviewed' GROUP BY 1", "w"))
def unreviewed_counts(spark, d):
    return reports.unreviewed_counts(ad.warrants(spark, d))


@register(sql("SELECT plant_id, attribute_id, id, status FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY created_at DESC, id DESC) AS r FROM c) WHERE r = 1", "c"))
def latest_claim(spark, d):
    return reports.latest_claim(ad.claims(spark, d)).select("plant_id", "attribute_id", "id", "status")


@register(sql("SELECT w.plant_id, w.attribute_id, count(DISTINCT w.id) AS n_warrants, coalesce(string_agg(DISTINCT source_id, ', ' ORDER BY source_id), '') AS source_list, any_value(k.status) AS claim_status, bool_or(q.plant_id IS NOT NULL) AS in_conflict FROM w LEFT JOIN (SELECT plant_id, attribute_id, status FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY created_at DESC, id DESC) AS r FROM c) WHERE r = 1) k USING (plant_id, attribute_id) LEFT JOIN (SELECT DISTINCT plant_id, attribute_id FROM x) q ON q.plant_id = w.plant_id AND q.attribute_id = w.attribute_id GROUP BY 1, 2", "c", *CONFLICTS))
def claims_worklist(spark, d):
    return reports.claims_worklist(ad.warrants(spark, d), ad.claims(spark, d), _conflicts(spark, d))


RELIABILITY = [
    "concat('S', CAST(s_suppkey AS STRING)) AS source_id",
    "CASE s_suppkey % 8 WHEN 0 THEN 'meta_analysis' WHEN 1 THEN 'experimental' WHEN 2 THEN 'field_observation' WHEN 3 THEN 'literature_review' WHEN 4 THEN 'modeling' WHEN 5 THEN 'expert_opinion' WHEN 6 THEN 'Experimental' END AS methodology_type",
    "s_suppkey % 2 = 0 AS peer_reviewed",
    "CASE s_suppkey % 7 WHEN 0 THEN '1,200 plots' WHEN 1 THEN '1000' WHEN 2 THEN '100' WHEN 3 THEN '99+' WHEN 4 THEN 'unknown' WHEN 5 THEN '' END AS sample_size",
    "CASE s_suppkey % 5 WHEN 0 THEN 'local' WHEN 1 THEN 'regional' WHEN 2 THEN 'national' WHEN 3 THEN 'global' END AS geographic_specificity",
    "CASE s_suppkey % 4 WHEN 0 THEN 'current' WHEN 1 THEN 'recent' WHEN 2 THEN 'dated' END AS temporal_currency",
]


def _reliability(spark, d):
    return ad.table(spark, d, "supplier").selectExpr(*RELIABILITY)


# In whole numbers: 30 x method + 20 x peer + 15 x sample + 20 x geography + 15 x currency, each in hundredths.
SCORE = "SELECT concat('S', CAST(s_suppkey AS STRING)) AS source_id, floor((30 * [100, 90, 70, 60, 50, 40, 50, 50][s_suppkey % 8 + 1] + 20 * [100, 30][s_suppkey % 2 + 1] + 15 * [100, 70, 70, 40, 50, 50, 50][s_suppkey % 7 + 1] + 20 * [100, 80, 50, 30, 50][s_suppkey % 5 + 1] + 15 * [100, 70, 40, 50][s_suppkey % 4 + 1] + 50) / 100)::DOUBLE / 100 AS auto_score FROM supplier"


@register(SCORE)
def auto_score(spark, d):
    return cl.auto_score(_reliability(spark, d)).select("source_id", "auto_score")


@register(f"WITH w AS ({ad.CTE['w']}), r AS ({SCORE}), p AS (SELECT plant_id, attribute_id, lower(trim(value)) AS value, sum(CAST(coalesce(auto_score, 0.5) AS DECIMAL(10, 4))) AS weight, count(DISTINCT w.source_id) AS n_sources, count(*) AS n FROM w LEFT JOIN r USING (source_id) WHERE status <> 'excluded' GROUP BY 1, 2, 3), t AS (SELECT *, sum(weight) OVER (PARTITION BY plant_id, attribute_id) AS total, sum(n) OVER (PARTITION BY plant_id, attribute_id) AS warrant_count, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY weight DESC, n DESC, value) AS k FROM p) SELECT plant_id, attribute_id, value, round(weight::DOUBLE / total::DOUBLE + 1e-9::DOUBLE, 4) AS support, CAST(warrant_count AS BIGINT) AS warrant_count, CASE WHEN round(weight::DOUBLE / total::DOUBLE + 1e-9::DOUBLE, 4) >= 0.75 AND n_sources >= 2 THEN 'high' WHEN round(weight::DOUBLE / total::DOUBLE + 1e-9::DOUBLE, 4) >= 0.5 THEN 'moderate' ELSE 'low' END AS confidence FROM t WHERE k = 1")
def consensus_claims(spark, d):
    return cl.consensus_claims(ad.warrants(spark, d), cl.auto_score(_reliability(spark, d)).withColumn("reliability_score", F.col("auto_score")))


NAME = "CASE CAST(p_partkey % 10 AS INT) WHEN 0 THEN p_name WHEN 1 THEN substring(p_name, 1, length(p_name) - 1) WHEN 2 THEN concat(p_name, 'q') WHEN 3 THEN concat(split_part(p_name, ' ', 1), ' spp.') WHEN 4 THEN concat(p_name, ' ''Red''') WHEN 5 THEN concat('m', p_name) WHEN 6 THEN concat('former ', split_part(p_name, ' ', 2)) WHEN 7 THEN concat('former ', split_part(p_name, ' ', 2), ' ''Red''') WHEN 8 THEN concat('former x ', split_part(p_name, ' ', 2)) ELSE CASE WHEN p_size % 3 = 0 THEN 'former' WHEN p_size % 3 = 1 THEN concat(p_brand, ' ', p_type) ELSE concat(split_part(p_name, ' ', 1), ' ', lower(p_type)) END END"


def _named(spark, d):
    """Part names by key: as they are, with a letter dropped, a letter more, genus only, with a cultivar, with another genus, under a former name, that with a
    cultivar or a hybrid mark, or alone, and names like no entity's, of a known genus or none."""
    return ad.table(spark, d, "part").selectExpr("p_partkey AS source_row", f"{NAME} AS name")


def _names(spark, d):
    return _named(spark, d).select("name").distinct()


def _former(spark, d):
    """A backbone in which each second word has a former name that leads to the first part with it."""
    last = ad.table(spark, d, "part").groupBy(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("symbol")).agg(F.min("p_name").alias("first"))
    return last.selectExpr("symbol", "stack(2, concat('former ', symbol, ' L.'), 1, concat(first, ' L.'), 0) AS (name_full, is_synonym)")


NAMES_SQL = f"SELECT DISTINCT {NAME} AS name FROM part"
BARE_SQL = "replace(replace(name, ' ''Red''', ''), ' x ', ' ')"
PARSED_SQL = f"SELECT name, lower(split_part({BARE_SQL}, ' ', 1)) AS g, CASE WHEN name LIKE '% spp.' OR regexp_matches(split_part({BARE_SQL}, ' ', 2), '^[A-Z]') THEN NULL ELSE nullif(lower(split_part({BARE_SQL}, ' ', 2)), '') END AS s, split_part({BARE_SQL}, ' ', 1) AS genus FROM names"
INDEX_SQL = "SELECT lower(genus) AS g, lower(species) AS s, min(id) AS plant_id, count(*) AS match_count FROM e GROUP BY 1, 2"
MATCH_CTE = f"WITH e AS ({ad.CTE['e']}), names AS ({NAMES_SQL}), p AS ({PARSED_SQL}), i AS ({INDEX_SQL})"
# Every name against every entity that it may be compared with.
FUZZY_SQL = "SELECT *, row_number() OVER (PARTITION BY name ORDER BY sim DESC, plant_id) AS r FROM (SELECT p.name, i.plant_id, i.g, i.s, 1 - levenshtein(p.s, i.s) / greatest(length(p.s), length(i.s))::DOUBLE AS sim, TRUE AS in_genus FROM p JOIN i ON p.g = i.g WHERE p.s IS NOT NULL UNION ALL SELECT p.name, i.plant_id, i.g, i.s, 1 - levenshtein(concat_ws(' ', p.g, p.s), concat(i.g, ' ', i.s)) / greatest(length(concat_ws(' ', p.g, p.s)), length(concat(i.g, ' ', i.s)))::DOUBLE, FALSE FROM p CROSS JOIN i WHERE p.s IS NULL OR p.g NOT IN (SELECT g FROM i))"
SYNONYM_SQL = "SELECT split_part(p_name, ' ', 2) AS w, min(p_name) AS accepted FROM part GROUP BY 1"


@register(f"{MATCH_CTE} SELECT p.name, p.g, p.s, i.plant_id, i.match_count FROM p LEFT JOIN i ON p.g = i.g AND p.s = i.s")
def match_exact(spark, d):
    return matching.match_exact(_names(spark, d), ad.entities(spark, d)).select("name", "g", "s", "plant_id", "match_count")


ALTERNATIVES_SQL = "SELECT name, string_agg(concat(CAST(plant_id AS STRING), ':', g, ' ', s, ':', CAST(CAST(floor(sim * 10000 + 0.5) AS BIGINT) AS STRING)), '; ' ORDER BY r) AS alternatives FROM f WHERE r <= 3 GROUP BY 1"


def _flat(alternatives):
    """What ``ALTERNATIVES_SQL`` makes of the candidates: id, name and similarity in ten-thousandths."""
    return F.array_join(F.transform(alternatives, lambda a: F.concat_ws(":", a["plant_id"], F.concat_ws(" ", a["genus"], a["species"]), F.floor(a["similarity"] * 10000 + 0.5))), "; ")


@register(f"{MATCH_CTE}, f AS ({FUZZY_SQL}), l AS ({ALTERNATIVES_SQL}) SELECT x.name, x.plant_id, round(x.sim, 9) AS sim, coalesce(y.sim >= x.sim - 0.05::DOUBLE, FALSE) AS tie, l.alternatives FROM f x JOIN l USING (name) LEFT JOIN f y ON y.name = x.name AND y.r = 2 WHERE x.r = 1 AND x.sim >= 0.85")
def match_fuzzy(spark, d):
    return matching.match_fuzzy(_names(spark, d), ad.entities(spark, d)).select("name", "plant_id", F.round("sim", 9).alias("sim"), "tie", _flat("alternatives").alias("alternatives"))


@register(f"{MATCH_CTE}, f AS (SELECT p.name, i.plant_id, row_number() OVER (PARTITION BY p.name ORDER BY 1 - levenshtein(lower(p.name), concat(i.g, ' ', i.s)) / greatest(length(p.name), length(concat(i.g, ' ', i.s)))::DOUBLE DESC, i.plant_id) AS rank FROM p CROSS JOIN i) SELECT * FROM f WHERE rank <= 4")
def nearest_names(spark, d):
    """The four entities nearest to each whole name, however far."""
    e = kept(matching._index(ad.entities(spark, d)).select("plant_id", "g", "s", F.concat_ws(" ", "g", "s").alias("full")))
    return matching.nearest_names(kept(_names(spark, d).select("name", F.lower("name").alias("full"))), e, 4).select("name", "plant_id", F.col("r").alias("rank"))


MATCHED_SQL = f"""f AS ({FUZZY_SQL}), l AS ({ALTERNATIVES_SQL}), y AS (SELECT p.name, i.plant_id, y.accepted FROM p JOIN ({SYNONYM_SQL}) y ON p.g = 'former' AND p.s = y.w JOIN i ON i.g || ' ' || i.s = lower(y.accepted)), q AS (SELECT g, count(*) AS n, min(id) AS only_one FROM (SELECT lower(genus) AS g, id FROM e) GROUP BY 1),
k AS (SELECT p.name, p.g, p.s, p.genus, CASE WHEN i.plant_id IS NOT NULL THEN 'EXACT' WHEN y.plant_id IS NOT NULL THEN 'SYNONYM' WHEN p.s IS NULL AND q.g IS NOT NULL THEN 'GENUS_ONLY' WHEN f.sim >= 0.85 THEN 'FUZZY' ELSE 'NONE' END AS match_type, i.plant_id AS p1, y.plant_id AS p2, y.accepted, q.n, CASE WHEN q.n = 1 THEN q.only_one END AS p3, f.plant_id AS p4, f.sim, f.in_genus, f.g AS fg, f.s AS fs, z.sim AS second, l.alternatives FROM p LEFT JOIN i ON p.g = i.g AND p.s = i.s LEFT JOIN y ON y.name = p.name LEFT JOIN q ON q.g = p.g LEFT JOIN f ON f.name = p.name AND f.r = 1 LEFT JOIN f z ON z.name = p.name AND z.r = 2 LEFT JOIN l ON l.name = p.name),
t AS (SELECT name, match_type, CASE match_type WHEN 'EXACT' THEN p1 WHEN 'SYNONYM' THEN p2 WHEN 'GENUS_ONLY' THEN p3 WHEN 'FUZZY' THEN p4 END AS plant_id, round(CASE match_type WHEN 'EXACT' THEN 1 WHEN 'SYNONYM' THEN 0.95 WHEN 'GENUS_ONLY' THEN 0.5 WHEN 'FUZZY' THEN 0.9 * sim ELSE 0 END::DOUBLE, 9) AS confidence, match_type = 'FUZZY' AND coalesce(second >= sim - 0.05::DOUBLE, FALSE) AS tie, CASE WHEN match_type IN ('FUZZY', 'NONE') THEN alternatives ELSE '' END AS alternatives,
CASE match_type WHEN 'EXACT' THEN 'Exact match on ' || genus || ' ' || s WHEN 'SYNONYM' THEN 'Synonym resolved via USDA_PLANTS: ' || genus || ' ' || s || ' → ' || accepted WHEN 'GENUS_ONLY' THEN 'Genus-only match: ' || n || ' plants in genus ' || genus WHEN 'FUZZY' THEN 'Fuzzy match: ' || CASE WHEN in_genus THEN 'genus exact, species ' ELSE 'full name ' END || CASE WHEN sim = 1 THEN 'exact' ELSE CAST(floor(sim * 100 + 0.5) AS BIGINT) || '% similar' END ELSE 'No match found for ' || name || ' (best fuzzy: ' || fg || ' ' || fs || ' at ' || CAST(floor(sim * 100 + 0.5) AS BIGINT) || '%)' END AS notes FROM k)"""


def _matches(spark, d):
    return matching.match_entities(_names(spark, d), ad.entities(spark, d), _former(spark, d))


@register(f"{MATCH_CTE}, {MATCHED_SQL} SELECT * FROM t")
def match_entities(spark, d):
    return _matches(spark, d).select("name", "match_type", "plant_id", F.round("confidence", 9).alias("confidence"), "tie", _flat("alternatives").alias("alternatives"), "notes")


@register(f"{MATCH_CTE}, {MATCHED_SQL} SELECT p_partkey AS source_row, coalesce(t.match_type, 'NONE') AS match_type, t.plant_id, coalesce(t.notes, 'No match found') AS notes FROM part LEFT JOIN t ON p_size % 11 <> 0 AND t.name = {NAME}")
def match_rows(spark, d):
    """A row for each part, some of which have no name."""
    rows = _named(spark, d).join(ad.table(spark, d, "part").selectExpr("p_partkey AS source_row", "p_size % 11 = 0 AS blank"), "source_row").withColumn("name", F.when(~F.col("blank"), F.concat(F.lit(" "), "name")))
    return matching.match_rows(rows, _matches(spark, d)).select("source_row", "match_type", "plant_id", "notes")


@register(f"{MATCH_CTE} SELECT p.name, i.plant_id FROM p JOIN ({SYNONYM_SQL}) y ON p.g = 'former' AND p.s = y.w JOIN i ON i.g || ' ' || i.s = lower(y.accepted)")
def match_synonym(spark, d):
    return matching.match_synonym(_names(spark, d), ad.entities(spark, d), _former(spark, d))


@register(f"{MATCH_CTE} SELECT p.name, i.plant_id FROM p JOIN i ON p.g = i.g AND p.s = i.s WHERE p.name LIKE '%''Red'''")
def match_cultivar(spark, d):
    return matching.match_cultivar(_names(spark, d), ad.entities(spark, d))


@register(sql("SELECT plant_id, attribute_id, source, value FROM (SELECT e.id AS plant_id, a.id AS attribute_id, lower(concat(genus, ' ', species)) AS k FROM e CROSS JOIN a WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.plant_id = e.id AND w.attribute_id = a.id)) JOIN (SELECT p_size % 7 + 1 AS attribute_id, p_type AS source, lower(p_name) AS k, arg_max(p_brand, p_partkey) AS value FROM part GROUP BY 1, 2, 3) USING (attribute_id, k)", "w", "e", "a"))
def enrichment_candidates(spark, d):
    e = ad.entities(spark, d)
    gaps = eav.gap_matrix(e, ad.attributes(spark, d), ad.values(spark, d)).join(e.select(F.col("id").alias("plant_id"), "genus", "species"), "plant_id")
    src = ad.table(spark, d, "part").selectExpr("CAST(p_size % 7 + 1 AS BIGINT) AS attribute_id", "p_type AS source", "p_name AS name", "p_brand AS value", "p_partkey AS source_row")
    return matching.enrichment_candidates(gaps, src).select("plant_id", "attribute_id", "source", "value")


# Lines of the documents as sections: the line is the title, the one after it the summary.
NODES_SQL = "SELECT doc_id, i AS node_id, w[i] AS title, w[i + 1] AS summary FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents))"


def _sections(spark, d):
    lines = ad.table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("w"))
    return lines.select("doc_id", F.posexplode("w").alias("i", "title"), "w").select("doc_id", (F.col("i") + 1).cast("long").alias("node_id"), "title", F.get("w", F.col("i") + 1).alias("summary"))


@register(f"WITH n AS ({NODES_SQL}), q AS (SELECT DISTINCT query_id, unnest(string_split(query, ' ')) AS word FROM (VALUES (1, 'the and'), (2, 'der die')) v(query_id, query)), z AS (SELECT query_id, doc_id, node_id, sum(CASE WHEN contains(lower(title), word) THEN 3 ELSE 0 END + CASE WHEN contains(lower(coalesce(summary, '')), word) THEN 1 ELSE 0 END) AS score FROM n CROSS JOIN q GROUP BY 1, 2, 3) SELECT query_id, doc_id, CAST(node_id AS BIGINT) AS node_id, CAST(score AS BIGINT) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, node_id) AS rank FROM z WHERE score > 0) WHERE rank <= 5")
def search_nodes(spark, d):
    return docindex.search_nodes(_sections(spark, d), spark.createDataFrame([(1, "the and"), (2, "der die")], "query_id int, query string"))


@register("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM pages")
def page_text(spark, d):
    return ad.table(spark, d, "pages").select("page_id", names.strip_tags("html").alias("text"))


@register()
def html_tables(spark, d):
    return harvest.html_tables(ad.table(spark, d, "pages"))


@register("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return reports.value_counts(ad.table(spark, d, "events"), "event_type")


@register(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if(trim(CAST({c} AS STRING)) <> '') AS n_filled, count(*) AS n_rows FROM documents" for c in ("doc_id", "text", "lang", "source", "n_chars")))
def field_fill(spark, d):
    return reports.field_fill(ad.table(spark, d, "documents"))


@register(sql("SELECT w.id FROM w WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = w.plant_id AND p_size > 25)", "w"))
def orphan_warrants(spark, d):
    some = ad.table(spark, d, "part").filter("p_size > 25").selectExpr("p_partkey AS id")
    return evidence.orphans(ad.warrants(spark, d), some, "plant_id").select("id")
