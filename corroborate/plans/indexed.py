"""Registered queries of searches by index, trees, chunks, numbered rows, grids of tables, stored snapshots and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import claims as cl
from ..operators import docindex, eav, evidence, harvest, reports
from ..sources import scratch, tables
from ..streaming import streams
from . import adapters as ad
from . import further
from . import registry as rg
from .adapters import sql
from .registry import register

# Lookups and listings.

ASKED = "CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN concat('old ', p_name) ELSE concat(p_name, ' ''Red''') END"
ROW_NAME = "CASE p_brand WHEN 'Brand#1' THEN split_part(p_name, ' ', 1) WHEN 'Brand#2' THEN concat(p_name, ' Mill. ex L.') ELSE CASE WHEN p_size % 3 = 0 THEN concat(p_name, ' ''Red''') ELSE p_name END END"
STRATEGIES = [("Brand#1", "genus"), ("Brand#2", "prefix"), ("Brand#3", "synonymy")]


@register(
    f"""WITH n AS (SELECT DISTINCT {ASKED} AS asked FROM part), r AS (SELECT p_brand AS dataset, p_partkey AS source_row, {ROW_NAME} AS name, p_type, p_size FROM part),
h AS (SELECT asked, dataset, source_row, name, 1.0::DOUBLE AS confidence FROM n JOIN r ON lower(asked) = lower(name) WHERE dataset NOT IN ('Brand#1', 'Brand#2') UNION ALL SELECT asked, dataset, source_row, name, 0.8::DOUBLE FROM n JOIN r ON lower(split_part(asked, ' ', 1)) = lower(name) WHERE dataset = 'Brand#1' UNION ALL SELECT asked, dataset, source_row, name, 1.0::DOUBLE FROM n JOIN r ON starts_with(lower(name), lower(asked)) WHERE dataset = 'Brand#2'),
y AS (SELECT asked, dataset, source_row, name, 0.9::DOUBLE AS confidence FROM n JOIN r ON starts_with(asked, 'old ') AND lower(substr(asked, 5)) = lower(name) WHERE dataset = 'Brand#3' AND NOT EXISTS (SELECT 1 FROM h WHERE h.asked = n.asked AND h.dataset = r.dataset)),
f AS (SELECT asked, dataset, arg_min(name, source_row) AS matched_name, min(source_row) AS source_row, confidence FROM (SELECT * FROM h UNION ALL SELECT * FROM y) GROUP BY asked, dataset, confidence)
SELECT asked, f.dataset, matched_name, c AS "column", v AS value, confidence, CASE c WHEN 'p_type' THEN 7 END AS attribute_id, CASE c WHEN 'p_type' THEN 'kind' END AS attribute_name FROM f JOIN (SELECT source_row, 'p_type' AS c, p_type AS v FROM r UNION ALL SELECT source_row, 'P_Size', CAST(p_size AS STRING) FROM r) x USING (source_row)"""
)
def lookup_sources(spark, d):
    p = ad.table(spark, d, "part")
    long = p.selectExpr("p_brand AS dataset", "p_partkey AS source_row", f"{ROW_NAME} AS name", "stack(4, 'p_type', p_type, 'P_Size', concat(p_size, ' '), 'symbol', p_name, 'empty', ' ') AS (column, value)")
    former = p.selectExpr("upper(concat('old ', p_name)) AS original_name", "p_name AS taxon_name")
    known = spark.createDataFrame([("P_TYPE", 7, "kind")], "column string, attribute_id int, attribute_name string")
    return eav.lookup_sources(p.selectExpr(f"{ASKED} AS name"), long, spark.createDataFrame(STRATEGIES, "dataset string, strategy string"), former, known)


LISTED = "CASE CAST(p_size % 4 AS INT) WHEN 0 THEN concat('(', upper(p_name), ')') WHEN 1 THEN concat('x-', p_name, ' L.') WHEN 2 THEN concat('see also ', p_name) ELSE p_brand END"


@register(f"WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 5 = 0 THEN ' ' WHEN p_partkey % 5 = 1 THEN substring(p_name, 2, 2) WHEN p_partkey % 5 = 2 THEN concat(' ', p_name) ELSE p_name END AS name FROM part), l AS (SELECT DISTINCT p_type AS list, lower({LISTED}) AS t FROM part WHERE p_size > 35) SELECT name, coalesce(string_agg(DISTINCT list, ', ' ORDER BY list), '') AS listed_in FROM n LEFT JOIN l ON trim(name) <> '' AND contains(t, lower(trim(name))) GROUP BY 1")
def listing_status(spark, d):
    """Names and parts of names, listed in brackets, behind a mark or within a sentence."""
    p = ad.table(spark, d, "part")
    asked = p.selectExpr("CASE WHEN p_partkey % 5 = 0 THEN ' ' WHEN p_partkey % 5 = 1 THEN substring(p_name, 2, 2) WHEN p_partkey % 5 = 2 THEN concat(' ', p_name) ELSE p_name END AS name")
    return eav.listing_status(asked, p.filter("p_size > 35").selectExpr("p_type AS list", f"{LISTED} AS text")).withColumn("listed_in", F.array_join("listed_in", ", "))


# A query for each customer segment and many for the suppliers' names.
QUERIES_SQL = "SELECT s_suppkey AS query_id, concat('the ', substring(s_name, 10, 6), ' ', substring(split_part(n_name, ' ', 1), 1, 3), ' an') AS query FROM supplier JOIN nation ON n_nationkey = s_nationkey"


@register(f"WITH n AS ({rg.NODES_SQL}), q AS (SELECT DISTINCT query_id, unnest(string_split(lower(query), ' ')) AS word FROM ({QUERIES_SQL})), u AS (SELECT DISTINCT word FROM q WHERE length(word) >= 2), z AS (SELECT word, doc_id, node_id, CASE WHEN contains(lower(title), word) THEN 3 ELSE 0 END + CASE WHEN contains(lower(coalesce(summary, '')), word) THEN 1 ELSE 0 END AS points FROM n CROSS JOIN u), s AS (SELECT query_id, doc_id, node_id, sum(points) AS score FROM z JOIN q USING (word) WHERE points > 0 GROUP BY 1, 2, 3) SELECT query_id, doc_id, CAST(node_id AS BIGINT) AS node_id, CAST(score AS BIGINT) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, node_id) AS rank FROM s) WHERE rank > 2 AND rank <= 5")
def search_many(spark, d):
    """Many queries at once, the third to fifth result of each."""
    queries = ad.table(spark, d, "supplier").join(ad.table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    queries = queries.selectExpr("s_suppkey AS query_id", "concat('the ', substring(s_name, 10, 6), ' ', substring(split_part(n_name, ' ', 1), 1, 3), ' an') AS query")
    return docindex.search_nodes(rg._sections(spark, d), queries, 3, 2)


# Trees and chunks.


def _chains(spark, d):
    """Chains of up to 300 parts under a root each, and one node whose parent is unknown."""
    p = ad.table(spark, d, "part").selectExpr("concat('p', p_partkey) AS id", "concat(p_brand, '/', p_partkey % 300) AS name", "CASE WHEN p_partkey % 300 = 7 THEN 'none' WHEN p_partkey % 300 > 0 THEN concat('p', p_partkey - 1) END AS parent_attribute_id")
    return p


CHAINS_SQL = "WITH RECURSIVE t AS (SELECT concat('p', CAST(p_partkey AS STRING)) AS id, concat(p_brand, '/', CAST(p_partkey % 300 AS STRING)) AS name, CASE WHEN p_partkey % 300 = 7 THEN 'none' WHEN p_partkey % 300 > 0 THEN concat('p', CAST(p_partkey - 1 AS STRING)) END AS parent FROM part), p AS (SELECT id, name, name AS root_name, name AS path, 1 AS level FROM t WHERE parent IS NULL OR parent NOT IN (SELECT id FROM t) UNION ALL SELECT t.id, t.name, p.root_name, concat(p.path, ' > ', t.name), p.level + 1 FROM t JOIN p ON t.parent = p.id)"


@register(f"{CHAINS_SQL} SELECT id, root_name, level, sha256(path) AS path FROM p")
def deep_paths(spark, d):
    return eav.attribute_paths(_chains(spark, d)).select("id", "root_name", "level", F.sha2("path", 256).alias("path"))


@register("WITH RECURSIVE t AS (" + ad.CTE["t"] + "), p AS (SELECT id, name, name AS path, 1 AS level FROM t WHERE parent IS NULL UNION ALL SELECT t.id, t.name, concat(p.path, ' > ', t.name), p.level + 1 FROM t JOIN p ON t.parent = p.id) SELECT * FROM p WHERE name = 'NATION_3' OR contains(path, 'NATION_3 > ')")
def subtree(spark, d):
    return eav.subtree(ad.tree(spark, d), "NATION_3")


@register("WITH RECURSIVE t AS (" + ad.CTE["t"] + "), p AS (SELECT id, name FROM t WHERE id = 'r2' UNION ALL SELECT t.id, t.name FROM t JOIN p ON t.parent = p.id) SELECT * FROM p")
def subtree_range(spark, d):
    """All below one root, as a range of codes."""
    return eav.below(eav.tree_codes(ad.tree(spark, d)), f"r2{eav.STEP}").select("id", "name")


def _chunk_sql(pages, budget, overlap):
    """The walk over the pages, one break after the other."""
    return f"""WITH RECURSIVE pg AS ({pages}), s AS (SELECT doc_id, page, t, row_number() OVER w - 1 AS i, sum(t) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM pg WINDOW w AS (PARTITION BY doc_id ORDER BY page, t)),
m AS (SELECT doc_id, max(upto) AS total, count(*) AS n, CASE WHEN max(upto) <= {budget} THEN max(upto) ELSE ceil((max(upto) / ceil(max(upto) / {budget}::DOUBLE) + {budget}) / 2::DOUBLE) END AS even FROM s GROUP BY 1),
r AS (SELECT doc_id, 0 AS chunk, -1::BIGINT AS i FROM m UNION ALL SELECT r.doc_id, r.chunk + 1, x.j FROM r, LATERAL (SELECT min(s.i) AS j FROM s JOIN m USING (doc_id) WHERE s.doc_id = r.doc_id AND s.i > r.i AND s.upto - coalesce((SELECT b.upto - b.t FROM s b WHERE b.doc_id = r.doc_id AND b.i = greatest(r.i - {overlap}, 0)), 0) > m.even) x WHERE x.j IS NOT NULL),
c AS (SELECT doc_id, chunk, greatest(i - {overlap}, 0) AS a, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY chunk), n) - 1 AS z FROM r JOIN m USING (doc_id))
SELECT c.doc_id, chunk, CASE WHEN z >= a THEN f.page END AS first_page, CASE WHEN z >= a THEN l.page END AS last_page, CAST(CASE WHEN z >= a THEN l.upto - f.upto + f.t ELSE 0 END AS BIGINT) AS tokens FROM c LEFT JOIN s f ON f.doc_id = c.doc_id AND f.i = a LEFT JOIN s l ON l.doc_id = c.doc_id AND l.i = z"""


@register(_chunk_sql("SELECT conv_id AS doc_id, turn AS page, length(coalesce(text, '')) // 4 AS t FROM conversations", 60, 1))
def chunk_pages(spark, d):
    return docindex.chunk_pages(ad.table(spark, d, "conversations").selectExpr("conv_id AS doc_id", "turn AS page", "text"), 60, 1)


@register(_chunk_sql("SELECT source AS doc_id, doc_id AS page, length(coalesce(text, '')) // 4 AS t FROM documents WHERE source IS NOT NULL", 900, 2))
def chunk_long(spark, d):
    """Each source's documents as the pages of one long document."""
    return docindex.chunk_pages(ad.table(spark, d, "documents").filter("source is not null").selectExpr("source AS doc_id", "doc_id AS page", "text"), 900, 2)


@register(sql("SELECT concat('r', CAST(r_regionkey AS STRING)) AS parent_id, concat('n', CAST(n_nationkey AS STRING)) AS node_id, n_name AS title FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_regionkey = 2", "t"))
def children(spark, d):
    nodes = ad.tree(spark, d).selectExpr("id AS node_id", "parent_attribute_id AS parent_id", "name AS title")
    return docindex.children(nodes, "r2").select("parent_id", "node_id", "title")


# Files.


@register("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END AS part_of, row_number() OVER (PARTITION BY p_partkey % 3 = 0 ORDER BY p_partkey) + 1 AS source_row FROM part")
def with_source_row(spark, d):
    """Two files of many splits each, numbered apart."""
    at, small = scratch.folder(spark), spark.conf.get("spark.sql.files.maxPartitionBytes")
    p = ad.table(spark, d, "part").selectExpr("p_partkey", "p_name", "CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END AS part_of")
    for f in ("a", "b"):
        p.filter(F.col("part_of") == f).repartitionByRange(1, "p_partkey").sortWithinPartitions("p_partkey").write.csv(f"{at}/{f}", header=True, sep="|")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        out = scratch.kept(tables.with_source_row(tables.read_delimited(spark, f"{at}/*", "|")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    return out.select(F.col("p_partkey").cast("long").alias("p_partkey"), "part_of", F.col("source_row"))


@register("SELECT p_name AS name, CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS size, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'é' || p_brand END AS maker FROM part")
def read_semicolons(spark, d):
    """Semicolons and another encoding; rows that end early and rows with a cell too many."""
    at = scratch.folder(spark)
    p = ad.table(spark, d, "part")
    line = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).when(F.col("p_size") % 3 == 1, F.concat_ws(";", "p_name", F.col("p_size").cast("string"), F.concat(F.lit("é"), "p_brand"), F.lit("more"))).otherwise(F.concat_ws(";", F.concat(F.lit('"'), "p_name", F.lit('"')), F.col("p_size").cast("string"), F.concat(F.lit("é"), "p_brand")))
    p.select(line.alias("name;size;maker")).write.csv(at, header=True, sep="\x01", quote="", escapeQuotes=False, encoding="ISO-8859-1")
    return tables.read_delimited(spark, at, ";", "ISO-8859-1")


# Grids of tables.

GRID = """concat('<table id="other"><tr><td>no</td></tr></table><table id="plantsList"><tbody><tr><th colspan="2">Name</th><th>Size</th></tr><tr><td rowspan="2"><a href="/x/plants/', replace(p_name, ' ', '-'), '?">', p_name, '</a></td><td>', p_brand, '<table><tr><td>in</td><td>', p_size, '</td></tr></table></td><td>', p_size, '</td></tr><tr><td colspan="2"> ', p_type, ' <td>late</tr></tbody></table>') AS html"""


@register("SELECT p_partkey AS page_id, table_no, row_no, CASE WHEN table_no = 1 THEN 'plantsList' WHEN table_no = 0 THEN 'other' END AS table_id, cells, is_header, CASE WHEN table_no = 1 AND row_no = 1 THEN replace(p_name, ' ', '-') || '?' END AS slug FROM (SELECT *, 0 AS table_no, 0 AS row_no, 'no' AS cells, FALSE AS is_header FROM part UNION ALL SELECT *, 1, 0, 'Name|Name|Size', TRUE FROM part UNION ALL SELECT *, 1, 1, concat(p_name, '|', p_brand, '|', CAST(p_size AS STRING)), FALSE FROM part UNION ALL SELECT *, 1, 2, concat(p_name, '|', p_type, '|', p_type, '|late'), FALSE FROM part UNION ALL SELECT *, 2, 0, concat('in|', CAST(p_size AS STRING)), FALSE FROM part)")
def html_table_grid(spark, d):
    """A table within a cell, cells over several rows and columns, a table with an id, links."""
    out = harvest.html_tables(ad.table(spark, d, "part").selectExpr("p_partkey AS page_id", GRID))
    return out.select("page_id", "table_no", "row_no", "table_id", F.array_join("cells", "|").alias("cells"), "is_header", harvest.table_slug("link").alias("slug"))


# Stored snapshots.


@register(rg.ORACLES["snapshot_diff"])
def stored_diff(spark, d):
    """The diff of two snapshots that were stored by range of id with digests; the second is made from the first as it is stored."""
    at = scratch.folder(spark)
    bounds = cl.range_bounds(ad.values(spark, d), "id", 16)
    cl.write_snapshot(rg._values_once(spark, d), f"{at}/old", ["id"], bounds)
    old = spark.read.parquet(f"{at}/old/rows").drop("__range__")
    cl.write_snapshot(rg._synced(spark, d, old), f"{at}/new", ["id"], bounds)
    return cl.stored_diff(spark, f"{at}/old", f"{at}/new", ["id"]).select("id", "change", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))


# Streams.


@register("SELECT epoch(w)::BIGINT AS window_start, event_type AS source, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w FROM events) WHERE w + INTERVAL 2 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2")
def stream_counts_appended(spark, d):
    """Sliding windows of two days in append mode: those that the watermark has passed, each written once when its state goes."""
    src = further._stream(spark, d, "events")
    out = streams.stream_evidence_counts(src, "2 days", "1 day", time="ts", source="event_type")
    return further._drained(out, scratch.folder(spark), "append", ad.table(spark, d, "events")).select(F.unix_timestamp("window_start").alias("window_start"), "source", "n")



# Reports by page, order and filter.


@register(sql("SELECT dimension, key, n, rank FROM (SELECT 'corroborated' AS dimension, '' AS key, count_if(value_a = value_b) AS n, 0 AS rank FROM pairs UNION ALL SELECT 'complementary', '', count_if(value_a <> value_b AND 'unknown' IN (value_a, value_b)), 0 FROM pairs UNION ALL SELECT 'conflicts', '', count(*), 0 FROM x UNION ALL SELECT 'entities', '', count(DISTINCT plant_id), 0 FROM x UNION ALL SELECT 'top_entity', CAST(plant_id AS STRING), n, r FROM (SELECT plant_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, plant_id) AS r FROM x GROUP BY 1) WHERE r <= 10 UNION ALL SELECT 'top_attribute', CAST(attribute_id AS STRING), n, r FROM (SELECT attribute_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, attribute_id) AS r FROM x GROUP BY 1) WHERE r <= 10)", *rg.CONFLICTS))
def scan_report(spark, d):
    return reports.scan_report(evidence.classify_pairs(rg._pairs(spark, d)), rg._conflicts(spark, d))


@register(sql("SELECT plant_id, attribute_id, n_warrants, (SELECT count(*) FROM g) AS total FROM g ORDER BY n_warrants DESC, plant_id, attribute_id LIMIT 20 OFFSET 10", "w").replace(" SELECT plant_id", ", g AS (SELECT plant_id, attribute_id, count(*) AS n_warrants FROM w WHERE status <> 'excluded' AND warrant_type = 'external' GROUP BY 1, 2 HAVING count(*) >= 2) SELECT plant_id", 1))
def warrant_groups_page(spark, d):
    rows, total = evidence.warrant_groups_page(ad.warrants(spark, d), 20, 10, mode="external")
    return rows.withColumn("total", total.scalar())


@register(sql("SELECT 'status' AS option, status AS value FROM x UNION SELECT 'severity', severity FROM x UNION SELECT 'type', conflict_type FROM x UNION SELECT 'mode', conflict_mode FROM x UNION SELECT 'category', 'other' FROM x UNION SELECT 'source', source_a FROM x WHERE source_a IS NOT NULL UNION SELECT 'source', source_b FROM x WHERE source_b IS NOT NULL UNION SELECT 'claim_status', status FROM c UNION SELECT 'warrant_source', source_id FROM w WHERE source_id IS NOT NULL", "c", *rg.CONFLICTS))
def filter_options_all(spark, d):
    return reports.filter_options(rg._conflicts(spark, d), ad.claims(spark, d), ad.warrants(spark, d))


WORKLIST = "SELECT w.plant_id, w.attribute_id, count(DISTINCT w.id) AS n_warrants, any_value(k.status) AS claim_status, bool_or(q.plant_id IS NOT NULL) AS in_conflict FROM (SELECT * FROM w{where}) w LEFT JOIN (SELECT plant_id, attribute_id, status FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY created_at DESC, id DESC) AS r FROM c) WHERE r = 1) k USING (plant_id, attribute_id) LEFT JOIN (SELECT DISTINCT plant_id, attribute_id FROM x) q ON q.plant_id = w.plant_id AND q.attribute_id = w.attribute_id GROUP BY 1, 2"


@register(sql(f"SELECT * FROM ({WORKLIST.format(where='')}) WHERE in_conflict AND claim_status = 'approved' ORDER BY in_conflict DESC, n_warrants DESC, plant_id, attribute_id LIMIT 500", "c", *rg.CONFLICTS))
def worklist_page(spark, d):
    out = reports.claims_worklist(ad.warrants(spark, d), ad.claims(spark, d), rg._conflicts(spark, d), has_conflicts=True, claim_status="approved")
    return reports.worklist_page(out).drop("source_list")


@register(sql(f"SELECT * FROM ({WORKLIST.format(where=" WHERE source_id = 'S1'")}) WHERE claim_status IS NULL", "c", *rg.CONFLICTS))
def worklist_of_source(spark, d):
    return reports.claims_worklist(ad.warrants(spark, d), ad.claims(spark, d), rg._conflicts(spark, d), claim_status="none", source="S1").drop("source_list")


@register(sql("SELECT id, name, attribute_count, completeness_pct, total FROM (SELECT e.id, e.name, count(w.id) AS attribute_count, floor(count(DISTINCT CASE WHEN w.attribute_id <= 3 THEN w.attribute_id END) / 3::DOUBLE * 1000 + 0.5) / 10 AS completeness_pct, (SELECT count(*) FROM e WHERE contains(lower(name), 'ar') OR contains(lower(common_name), 'ar')) AS total FROM e LEFT JOIN w ON w.plant_id = e.id WHERE contains(lower(e.name), 'ar') OR contains(lower(e.common_name), 'ar') GROUP BY 1, 2) ORDER BY completeness_pct DESC, id LIMIT 25 OFFSET 25", "e", "w"))
def entity_browser(spark, d):
    rows, total = eav.entity_browser(ad.entities(spark, d), ad.values(spark, d), [1, 2, 3], " AR ", "completeness", True, 2, 25)
    return rows.select("id", "name", "attribute_count", "completeness_pct").withColumn("total", total.scalar())


@register(sql("SELECT plant_id, count(*) AS n_unreviewed FROM w WHERE status = 'unreviewed' AND source_id = 'S2' AND attribute_id <> 3 GROUP BY 1", "w"))
def unreviewed_of_source(spark, d):
    w = ad.warrants(spark, d).withColumn("source_id_code", F.when(F.col("attribute_id") == 3, reports.AUDIT_CODE).when(F.col("attribute_id") == 4, "X"))
    return reports.unreviewed_counts(w, "S2", ordered=True)


@register(sql("SELECT id FROM x WHERE status = 'pending' AND severity = 'moderate' AND conflict_type = 'SCOPE_DIFFERENCE' AND conflict_mode = 'internal' AND contains(lower(attribute_name), 'bute 2') UNION ALL SELECT id FROM x WHERE source_a = 'S3' OR source_b = 'S3'", *rg.CONFLICTS))
def filter_conflicts(spark, d):
    x = rg._conflicts(spark, d)
    every = reports.filter_conflicts(x, "pending", "moderate", "SCOPE_DIFFERENCE", "internal", "BUTE 2")
    return every.select("id").unionByName(reports.filter_conflicts(x, source="S3").select("id"))


# Every second conflict has a specialist's preference.
ADVICE = "CASE (plant_id + attribute_id) % 4 WHEN 0 THEN 'PREFER_A' WHEN 1 THEN 'PREFER_B' WHEN 2 THEN 'KEEP_BOTH' END"
ADVISED_SQL = f"WITH {', '.join(f'{n} AS ({ad.CTE[n]})' for n in rg.CONFLICTS)}, r AS ({rg.SCORE}), worse AS (SELECT DISTINCT CASE WHEN advice = 'PREFER_B' THEN warrant_a_id ELSE warrant_b_id END AS id FROM (SELECT *, {ADVICE} AS advice FROM x WHERE status <> 'dismissed') WHERE advice IN ('PREFER_A', 'PREFER_B')), p AS (SELECT plant_id, attribute_id, lower(trim(value)) AS value, sum(CAST(coalesce(auto_score, 0.5::DOUBLE) * CASE WHEN worse.id IS NULL THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS DECIMAL(10, 4))) AS weight, count(*) AS n FROM w LEFT JOIN r USING (source_id) LEFT JOIN worse ON worse.id = w.id WHERE status <> 'excluded' GROUP BY 1, 2, 3)"


@register(f"{ADVISED_SQL} SELECT plant_id, attribute_id, value, round(weight::DOUBLE / total::DOUBLE + 1e-9::DOUBLE, 4) AS support FROM (SELECT *, sum(weight) OVER (PARTITION BY plant_id, attribute_id) AS total, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY weight DESC, n DESC, value) AS k FROM p) WHERE k = 1")
def advised_claims(spark, d):
    """Claims that take what specialists advised into account."""
    x = rg._conflicts(spark, d).withColumn("specialist_recommendation", F.expr(ADVICE))
    rel = cl.auto_score(rg._reliability(spark, d)).withColumn("reliability_score", F.col("auto_score"))
    return cl.consensus_claims(ad.warrants(spark, d), rel, conflicts=x).select("plant_id", "attribute_id", "value", "support")


@register(f"WITH k AS ({rg.ORACLES['consensus_claims']}), w AS ({ad.CTE['w']}), r AS ({rg.SCORE}), l AS (SELECT w.plant_id, w.attribute_id, w.id AS warrant_id, lower(trim(w.value)) = k.value AS agrees, coalesce(r.auto_score, 0.5::DOUBLE) AS score FROM w JOIN k USING (plant_id, attribute_id) LEFT JOIN r USING (source_id) WHERE w.status <> 'excluded') SELECT plant_id, attribute_id, inclusion_reason, count(*) AS n FROM (SELECT *, CASE WHEN NOT agrees THEN 'contextual' WHEN score < max(CASE WHEN agrees THEN score END) OVER (PARTITION BY plant_id, attribute_id) THEN 'supporting' ELSE 'primary' END AS inclusion_reason FROM l) GROUP BY 1, 2, 3")
def claim_weights(spark, d):
    """Primary, supporting and contextual warrants of each claim."""
    rel = cl.auto_score(rg._reliability(spark, d)).withColumn("reliability_score", F.col("auto_score"))
    claims, links = cl.build_claims(rg.QUERIES["consensus_claims"](spark, d), ad.warrants(spark, d), rel)
    return links.join(claims.select(F.col("id").alias("claim_id"), "plant_id", "attribute_id"), "claim_id").groupBy("plant_id", "attribute_id", "inclusion_reason").agg(F.count("*").alias("n"))


# Texts and files.


@register("SELECT p_partkey, concat(p_name, ' x') AS text, p_size % 2 = 0 AS flagged FROM part")
def flag_marker(spark, d):
    p = ad.table(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("*!*  ")).otherwise("  "), "p_name", F.lit("\n\t x ")).alias("raw"))
    return p.select("p_partkey", names.flag_marker("raw")["text"].alias("text"), names.flag_marker("raw")["flagged"].alias("flagged"))


@register("SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'regional' WHEN 1 THEN 'national' WHEN 2 THEN 'global' WHEN 3 THEN 'local' WHEN 4 THEN 'regional' END AS as_words, CASE s_suppkey % 6 WHEN 0 THEN 'national' WHEN 1 THEN 'national' WHEN 2 THEN 'national' WHEN 3 THEN 'local' WHEN 4 THEN 'regional' END AS anywhere FROM supplier")
def specificity(spark, d):
    """Regions with a keyword within a word, as a word, and none."""
    s = ad.table(spark, d, "supplier").selectExpr("s_suppkey", "CASE s_suppkey % 6 WHEN 0 THEN 'Australia' WHEN 1 THEN 'the US, all' WHEN 2 THEN 'International' WHEN 3 THEN 'N. California' WHEN 4 THEN 'Idaho and Nevada' ELSE '' END AS r")
    return s.select("s_suppkey", names.infer_specificity("r", word_boundary=True).alias("as_words"), names.infer_specificity("r").alias("anywhere"))


def _files(df, at):
    """Files plants_<file>.csv in the folder ``at`` of the rows (file, value), side by side: a task for each, moved to its place."""
    spark = df.sparkSession
    df.repartition("file").write.partitionBy("file").text(f"{at}/.new")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path(f"{at}/.new")):
        if "=" in (name := folder.getPath().getName()):
            part = next(s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-"))
            fs.rename(part, path(f"{at}/plants{name.split('=')[1].replace('~', '')}.csv"))


@register("SELECT concat('plants_', CAST(p_partkey % 8 AS STRING), '.csv') AS file, p_name AS line FROM part")
def pick_source_files(spark, d):
    """A pointer in the place of the main file, so that the numbered ones are read; a pointer among those is left out."""
    at, p = scratch.folder(spark), ad.table(spark, d, "part")
    stub = spark.createDataFrame([(f, "version https://git-lfs.github.com/spec/v1") for f in ("~", "_9")], "file string, value string")
    _files(p.selectExpr("concat('_', p_partkey % 8) AS file", "p_name AS value").unionByName(stub), at)
    lines = spark.read.text(tables.pick_source_files(spark, at))
    return lines.select(F.regexp_extract("_metadata.file_path", "[^/]*$", 0).alias("file"), F.col("value").alias("line"))
