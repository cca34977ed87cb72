"""The model's tables from the given star-schema tables. Each is one select list, valid in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WARRANTS = """concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), CAST(CAST(floor(l_quantity) AS INT) AS STRING), CAST(CAST(floor(l_extendedprice) AS INT) AS STRING)) AS id
CAST(l_partkey AS BIGINT) AS plant_id
CAST(l_linenumber AS BIGINT) AS attribute_id
concat('attribute ', CAST(l_linenumber AS STRING)) AS attribute_name
CASE WHEN (l_orderkey + l_suppkey) % 17 = 0 THEN 'unknown' ELSE concat(l_returnflag, l_linestatus) END AS value
CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE concat('S', CAST(l_suppkey AS STRING)) END AS source_id
CASE WHEN l_suppkey % 3 = 0 THEN 'external' ELSE 'existing' END AS warrant_type
CASE WHEN l_quantity > 45 THEN 'excluded' WHEN l_quantity > 40 THEN NULL ELSE 'unreviewed' END AS status
CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS batch_id
l_shipdate AS created_at""".split("\n")

# What a reviewer said of a pair, and the state of the conflict it makes.
LABELS = """CASE attribute_id WHEN 1 THEN 'SCALE_MISMATCH' WHEN 2 THEN 'SCOPE_DIFFERENCE' WHEN 3 THEN 'TEMPORAL_CONFLICT' WHEN 4 THEN 'METHODOLOGY_DIFFERENCE' WHEN 5 THEN 'GRANULARITY_MISMATCH' WHEN 6 THEN 'DEFINITION_CONFLICT' ELSE CASE WHEN plant_id % 2 = 0 THEN 'NO_SUCH_TYPE' END END AS label
CASE plant_id % 5 WHEN 0 THEN 'critical' WHEN 1 THEN 'dreadful' END AS label_severity""".split("\n")
STATES = """concat(id_a, '|', id_b) AS id
concat('attribute ', CAST(attribute_id AS STRING)) AS attribute_name
CASE plant_id % 3 WHEN 0 THEN 'internal' WHEN 1 THEN 'external' ELSE 'cross_source' END AS conflict_mode
CASE (plant_id + attribute_id) % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'annotated' WHEN 2 THEN 'resolved' ELSE 'dismissed' END AS status""".split("\n")

CLAIMS = """CAST(o_orderkey AS STRING) AS id
CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'P' THEN 'draft' ELSE 'pushed' END AS status
CAST(o_orderkey % 2000 + 1 AS BIGINT) AS plant_id
CAST(o_orderkey % 7 + 1 AS BIGINT) AS attribute_id
CASE WHEN o_custkey % 5 = 0 THEN 'edited' END AS edited_value
CASE WHEN o_custkey % 2 = 0 THEN 'categorical' END AS categorical_value
o_orderpriority AS synthesized_text
o_orderdate AS approved_at
o_orderdate AS created_at
FALSE AS pushed_to_production""".split("\n")

ENTITIES = ["p_partkey AS id", "split_part(p_name, ' ', 1) AS genus", "split_part(p_name, ' ', 2) AS species", "p_brand AS common_name", "p_name AS name"]
SOURCES = ["concat('S', CAST(s_suppkey AS STRING)) AS id", "s_name AS name", "CAST(s_nationkey AS STRING) AS region"]
BATCHES = ["CAST(event_id AS STRING) AS id", "concat('D', CAST(user_id % 50 AS STRING)) AS source_dataset", "event_type AS batch_type", "ts AS started_at", "CASE WHEN event_id % 50 = 0 THEN 'running' ELSE 'complete' END AS status"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def warrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*WARRANTS)


values = warrants


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*CLAIMS)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*ENTITIES)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*SOURCES)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*BATCHES)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers, the first as the root of the others."""
    return table(spark, sf_dir, "lineitem").selectExpr("CAST(l_linenumber AS BIGINT) AS id").distinct().selectExpr("id", "concat('attribute ', CAST(id AS STRING)) AS name", "CASE WHEN id > 1 THEN CAST(1 AS BIGINT) END AS parent_attribute_id")


def warrant_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch for each month of warrants."""
    return warrants(spark, sf_dir).groupBy(F.col("batch_id").alias("id")).agg(F.min("created_at").alias("started_at")).withColumn("status", F.expr("CASE WHEN CAST(id AS INT) % 2 = 0 THEN 'completed' ELSE 'running' END"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and suppliers as an attribute tree."""
    r = table(spark, sf_dir, "region").selectExpr("concat('r', CAST(r_regionkey AS STRING)) AS id", "r_name AS name", "CAST(NULL AS STRING) AS parent_attribute_id")
    n = table(spark, sf_dir, "nation").selectExpr("concat('n', CAST(n_nationkey AS STRING)) AS id", "n_name AS name", "concat('r', CAST(n_regionkey AS STRING)) AS parent_attribute_id")
    s = table(spark, sf_dir, "supplier").selectExpr("concat('s', CAST(s_suppkey AS STRING)) AS id", "s_name AS name", "concat('n', CAST(s_nationkey AS STRING)) AS parent_attribute_id")
    return r.unionByName(n).unionByName(s)


def select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


#: DuckDB common table expressions of the same tables.
CTE = {
    "w": select(WARRANTS, "lineitem"),
    "c": select(CLAIMS, "orders"),
    "e": select(ENTITIES, "part"),
    "s": select(SOURCES, "supplier"),
    "b": select(BATCHES, "events"),
    "a": "SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS id, concat('attribute ', CAST(l_linenumber AS STRING)) AS name, CASE WHEN l_linenumber > 1 THEN 1 END AS parent FROM lineitem",
    "t": "SELECT concat('r', CAST(r_regionkey AS STRING)) AS id, r_name AS name, CAST(NULL AS STRING) AS parent FROM region UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), n_name, concat('r', CAST(n_regionkey AS STRING)) FROM nation UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), s_name, concat('n', CAST(s_nationkey AS STRING)) FROM supplier",
    "m": "SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY source_id NULLS FIRST, id) AS rn, count(*) OVER (PARTITION BY plant_id, attribute_id) AS n, count(*) OVER (PARTITION BY plant_id, attribute_id, lower(trim(value))) AS votes FROM w WHERE status <> 'excluded'",
    "anchors": "SELECT plant_id, attribute_id, rn AS anchor FROM (SELECT *, row_number() OVER (PARTITION BY plant_id, attribute_id ORDER BY votes DESC, rn) AS o FROM m) WHERE o = 1",
    "pairs": "SELECT x.plant_id, x.attribute_id, x.id AS id_a, y.id AS id_b, x.value AS value_a, y.value AS value_b, x.source_id AS source_id_a, y.source_id AS source_id_b FROM m x JOIN m y ON x.plant_id = y.plant_id AND x.attribute_id = y.attribute_id JOIN anchors k ON k.plant_id = x.plant_id AND k.attribute_id = x.attribute_id WHERE x.n >= 2 AND CASE WHEN x.n <= 5 THEN x.rn < y.rn ELSE x.rn = k.anchor AND y.rn <> k.anchor END",
    # The rules of types, severities and routes written out again, as one CASE each.
    "x": "SELECT id, plant_id, attribute_id, attribute_name, id_a AS warrant_a_id, id_b AS warrant_b_id, value_a, value_b, source_id_a AS source_a, source_id_b AS source_b, conflict_mode, status, kind AS conflict_type, "
    "CASE WHEN gap THEN 'minor' WHEN label_severity IN ('minor', 'moderate', 'critical') THEN label_severity WHEN label IS NULL AND label_severity IS NULL THEN 'moderate' WHEN kind = 'RATING_DISAGREEMENT' THEN 'critical' WHEN kind IN ('TEMPORAL_CONFLICT', 'GRANULARITY_MISMATCH') THEN 'minor' ELSE 'moderate' END AS severity, "
    "CASE WHEN gap THEN NULL WHEN kind IN ('RATING_DISAGREEMENT', 'SCALE_MISMATCH') THEN 'ratingConflictFlow' WHEN kind = 'GRANULARITY_MISMATCH' THEN 'taxonomyConflictFlow' ELSE concat(lower(split_part(kind, '_', 1)), 'ConflictFlow') END AS specialist_agent "
    f"FROM (SELECT *, CASE WHEN gap THEN 'COMPLETENESS_CONFLICT' WHEN label IS NULL OR label = 'NO_SUCH_TYPE' THEN 'RATING_DISAGREEMENT' ELSE label END AS kind FROM (SELECT *, (value_a = 'unknown') <> (value_b = 'unknown') AS gap, {', '.join(LABELS + STATES)} FROM pairs WHERE lower(trim(value_a)) <> lower(trim(value_b))))",
}


def sql(body: str, *needs: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({CTE[n]})" for n in needs) + " " + body
