"""Reports over conflicts, claims, warrants and batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import attribute_category
from .evidence import PAIR, SEVERITIES, severity_rank


# Conflicts with these statuses count as unresolved or as resolved.
UNRESOLVED, RESOLVED = ("pending", "annotated"), ("resolved", "dismissed")


def _open() -> Column:
    return F.col("status").isin(*UNRESOLVED)


def _resolved() -> Column:
    return F.col("status").isin(*RESOLVED)


def filter_conflicts(conflicts: DataFrame, status: str | None = None, severity: str | None = None, conflict_type: str | None = None, mode: str | None = None, attribute_like: str | None = None, source: str | None = None, pair: tuple[str, str] | None = None) -> DataFrame:
    out = conflicts
    for col, v in (("status", status), ("severity", severity), ("conflict_type", conflict_type), ("conflict_mode", mode)):
        out = out if v is None else out.filter(F.col(col) == v)
    if attribute_like is not None:
        out = out.filter(F.lower("attribute_name").contains(attribute_like.lower()))
    if source is not None:
        out = out.filter((F.col("source_a") == source) | (F.col("source_b") == source))
    if pair is not None:
        a, b = pair
        out = out.filter(((F.col("source_a") == a) & (F.col("source_b") == b)) | ((F.col("source_a") == b) & (F.col("source_b") == a)))
    return out


def page(df: DataFrame, key: str, number: int = 1, size: int = 50, descending: bool = False, allowed: tuple[str, ...] = (), tie: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """One page of ``df`` (numbers from 1), and one row with the ``total`` of all its rows.

    A key that is not ``allowed`` gives way to the first of them. Severities go from critical to minor, unknown ones last.
    Nulls come last; ``tie`` columns make the order, and so the pages, unambiguous.
    """
    key = key if key in allowed or not allowed else allowed[0]
    by = -severity_rank(key) if key == "severity" else F.col(key)
    order = by.desc_nulls_last() if descending else by.asc_nulls_last()
    return df.orderBy(order, *tie).offset(size * (max(number, 1) - 1)).limit(size), df.agg(F.count("*").alias("total"))


def scan_report(pairs: DataFrame, conflicts: DataFrame, k: int = 10) -> DataFrame:
    """(dimension, key, n, rank) of a scan: pairs that corroborate each other, pairs of which one side is missing (complementary), conflicts,
    entities in conflict, and the ``k`` entities and attributes with most conflicts.

    ``pairs`` have the verdict of ``classify_pairs``. The lists are first rows of counts, which each task cuts before they meet.
    """
    said = pairs.agg(F.count_if(F.col("verdict") == "corroborated").alias("corroborated"), F.count_if(F.col("verdict") == "COMPLETENESS_CONFLICT").alias("complementary"))
    found = conflicts.agg(F.count("*").alias("conflicts"), F.countDistinct("plant_id").alias("entities"))
    one = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.lit("").alias("key"), F.col(c).alias("n"), F.lit(0).alias("rank")) for c in df.columns])).alias("x")).select("x.*")
    out = one(said).unionByName(one(found))
    for name, column in (("top_entity", "plant_id"), ("top_attribute", "attribute_id")):
        top = conflicts.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)
        ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), column)))  # k rows
        out = out.unionByName(ranked.select(F.lit(name).alias("dimension"), F.col(column).cast("string").alias("key"), "n", "rank"))
    return out


def conflict_matrix(conflicts: DataFrame) -> DataFrame:
    """Per ordered source pair: total, by severity, pending (annotated ones are neither) and resolved or dismissed."""
    by = [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES]
    return conflicts.groupBy("source_a", "source_b").agg(F.count("*").alias("n"), *by, F.count_if(F.col("status") == "pending").alias("n_pending"), F.count_if(_resolved()).alias("n_resolved"))


def matrix_max(matrix: DataFrame) -> DataFrame:
    """One row: the largest count of a pair (0 without pairs)."""
    return matrix.agg(F.coalesce(F.max("n"), F.lit(0)).alias("max_count"))


def conflict_matrix_wide(matrix: DataFrame, sources: list[str]) -> DataFrame:
    """Symmetric source x source counts; both orders of a pair are added."""
    flip = matrix.filter("source_a <> source_b").select(F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), "n")
    return matrix.select("source_a", "source_b", "n").unionByName(flip).groupBy("source_a").pivot("source_b", sources).agg(F.sum("n")).na.fill(0)


def source_conflict_summary(conflicts: DataFrame) -> DataFrame:
    side = lambda c: conflicts.select(F.col(c).alias("source"), "status", "severity")
    out = side("source_a").unionAll(side("source_b")).filter("source is not null").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "critical").alias("n_critical"), F.count_if(F.col("status") == "pending").alias("n_pending"), F.count_if(_resolved()).alias("n_resolved"))
    return out.withColumn("resolution_rate", F.round(100.0 * F.col("n_resolved") / F.col("n"), 1))


def pair_breakdown(conflicts: DataFrame, a: str, b: str) -> DataFrame:
    return filter_conflicts(conflicts, pair=(a, b)).groupBy("conflict_type", "severity").agg(F.count("*").alias("n"))


def top_pairs(conflicts: DataFrame, k: int = 10, status: str | None = None) -> DataFrame:
    pair = filter_conflicts(conflicts, status=status).filter("source_a is not null and source_b is not null").groupBy(F.least("source_a", "source_b").alias("source_1"), F.greatest("source_a", "source_b").alias("source_2")).agg(F.count("*").alias("n"))
    return pair.orderBy(F.desc("n"), "source_1", "source_2").limit(k)


def conflict_queue(conflicts: DataFrame, status: str | None = None) -> DataFrame:
    """Per entity: total, worst severity, distinct attributes, unresolved and queue status, the worst and fullest first.

    Complete without an unresolved conflict, in progress once one is resolved or dismissed, else pending.
    """
    rank = F.max(severity_rank())
    q = conflicts.groupBy("plant_id").agg(F.count("*").alias("n"), rank.alias("rank"), F.countDistinct("attribute_name").alias("n_attributes"), F.count_if(_open()).alias("n_open"), F.count_if(_resolved()).alias("n_done"))
    q = q.withColumn("queue_status", F.when(F.col("n_open") == 0, "complete").when(F.col("n_done") > 0, "in_progress").otherwise("pending"))
    q = q if status is None else q.filter(F.col("queue_status") == status)
    worst = F.when(F.col("rank") == 3, "critical").when(F.col("rank") == 2, "moderate").otherwise("minor")
    return q.orderBy(F.desc("rank"), F.desc("n_open"), "plant_id").select("plant_id", "n", worst.alias("max_severity"), "n_attributes", "n_open", "queue_status")


def conflict_attributes(conflicts: DataFrame, warrants: DataFrame) -> DataFrame:
    ids = warrants.groupBy("plant_id", "attribute_name").agg(F.min("attribute_id").alias("attribute_id"))
    c = conflicts.groupBy("plant_id", "attribute_name").agg(F.count("*").alias("n"), F.max(severity_rank()).alias("max_severity"))
    return c.join(ids, ["plant_id", "attribute_name"], "left")


def filter_options(conflicts: DataFrame, claims: DataFrame | None = None, warrants: DataFrame | None = None) -> DataFrame:
    """(option, value): distinct statuses, severities, types, modes, attribute categories and sources of either side, in one pass; the
    statuses of ``claims`` and the sources of ``warrants``, where they are given."""
    options = [("status", F.col("status")), ("severity", F.col("severity")), ("type", F.col("conflict_type")), ("mode", F.col("conflict_mode")), ("category", attribute_category("attribute_name")), ("source", F.col("source_a")), ("source", F.col("source_b"))]
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("option"), c.cast("string").alias("value")) for k, c in options])).alias("x")
    out = conflicts.select(both).select("x.*")
    for df, name, column in ((claims, "claim_status", "status"), (warrants, "warrant_source", "source_id")):
        if df is not None:
            out = out.unionByName(df.select(F.lit(name).alias("option"), F.col(column).cast("string").alias("value")))
    return out.filter("value is not null").distinct()


def claims_worklist(warrants: DataFrame, claims: DataFrame, conflicts: DataFrame, has_conflicts: bool = False, claim_status: str | None = None, source: str | None = None) -> DataFrame:
    """Each pair's warrants, their sources, the latest claim's status and whether it is in conflict.

    ``has_conflicts`` keeps pairs in conflict, ``claim_status`` those whose claim has it (none: those without a claim); with ``source`` only its
    warrants count. ``worklist_page`` puts them in order.
    """
    warrants = warrants if source is None else warrants.filter(F.col("source_id") == source)
    w = warrants.groupBy(*PAIR).agg(F.countDistinct("id").alias("n_warrants"), F.array_join(F.array_sort(F.collect_set("source_id")), ", ").alias("source_list"))
    c = claims.groupBy(*PAIR).agg(F.max_by("status", F.struct("created_at", "id")).alias("claim_status"))
    x = conflicts.select(*PAIR).distinct().withColumn("in_conflict", F.lit(True))
    out = w.join(c, PAIR, "left").join(x, PAIR, "left").withColumn("in_conflict", F.coalesce("in_conflict", F.lit(False)))
    out = out.filter("in_conflict") if has_conflicts else out
    if claim_status is None:
        return out
    return out.filter(F.col("claim_status").isNull() if claim_status == "none" else F.col("claim_status") == claim_status)


def worklist_page(worklist: DataFrame, most: int = 500) -> DataFrame:
    """The first ``most`` pairs: those in conflict first, then those of most warrants; ids break ties."""
    return worklist.orderBy(F.desc("in_conflict"), F.desc("n_warrants"), *PAIR).limit(most)


def latest_claim(claims: DataFrame) -> DataFrame:
    return claims.withColumn("__r__", F.row_number().over(Window.partitionBy(*PAIR).orderBy(F.desc("created_at"), F.desc("id")))).filter("__r__ = 1").drop("__r__")


def claim_view(claims: DataFrame, warrants: DataFrame, values: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Latest claim of each pair, its warrants ordered by source and id, the current value, and the ids of its conflicts if asked.

    One row holds all the warrants of a pair, as the view asks for; pairs without a claim are left out before they are gathered.
    """
    latest = latest_claim(claims)
    pairs = latest.select(*PAIR).distinct()
    warrants, values = warrants.join(pairs, PAIR, "left_semi"), values.join(pairs, PAIR, "left_semi")
    w = warrants.groupBy(*PAIR).agg(F.array_sort(F.collect_list(F.struct("source_id", "id", "value"))).alias("warrants"))
    v = values.groupBy(*PAIR).agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("current_value"))
    out = latest.join(w, PAIR, "left").join(v, PAIR, "left")
    if conflicts is None:
        return out
    x = conflicts.join(pairs, PAIR, "left_semi").groupBy(*PAIR).agg(F.array_sort(F.collect_list("id")).alias("conflict_ids"))
    return out.join(x, PAIR, "left")


def unsynthesized_pairs(warrants: DataFrame, claims: DataFrame, min_warrants: int = 2) -> DataFrame:
    """Pairs with at least two warrants, one of them external, and no claim."""
    g = warrants.groupBy(*PAIR).agg(F.count("*").alias("n_warrants"), F.count_if(F.col("warrant_type") == "external").alias("n_external")).filter((F.col("n_warrants") >= min_warrants) & (F.col("n_external") >= 1))
    return g.join(claims.select(*PAIR).distinct(), PAIR, "left_anti")


def curation_overlay(warrants: DataFrame, conflicts: DataFrame, claims: DataFrame) -> DataFrame:
    """Per entity: warrants by attribute (not excluded, not from the internal audit), unresolved conflicts by attribute name, the
    latest pending claim's status by attribute, and how many claims are approved. Maps have an entry for each attribute at most."""

    def mapped(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
        per = df.groupBy("plant_id", F.col(key).cast("string").alias("k")).agg(value.alias("v")).filter("k is not null")
        return per.groupBy("plant_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(name))

    w = mapped(warrants.filter("status <> 'excluded' and warrant_type <> 'internal_audit'"), "attribute_id", F.count("*"), "warrants")
    x = mapped(conflicts.filter(_open()), "attribute_name", F.count("*"), "open_conflicts")
    pending = claims.filter("status in ('draft', 'approved')")
    c = mapped(pending, "attribute_id", F.max_by("status", F.struct("created_at", "id")), "pending_claims")
    n = pending.groupBy("plant_id").agg(F.count_if(F.col("status") == "approved").alias("n_approved"))
    return w.join(x, "plant_id", "full").join(c, "plant_id", "full").join(n, "plant_id", "full").na.fill(0, ["n_approved"])


# Fixed value: warrants that the audit itself made.
AUDIT_CODE = "INTERNAL_AUDIT"


def unreviewed_counts(warrants: DataFrame, source: str | None = None, ordered: bool = False) -> DataFrame:
    """Unreviewed warrants by entity, without those of the audit (column source_id_code, where there is one); of one ``source``, and with the
    most first, if asked."""
    out = warrants.filter("status = 'unreviewed'")
    if "source_id_code" in warrants.columns:
        out = out.filter(F.col("source_id_code").isNull() | (F.col("source_id_code") != AUDIT_CODE))
    out = out if source is None else out.filter(F.col("source_id") == source)
    out = out.groupBy("plant_id").agg(F.count("*").alias("n_unreviewed"))
    return out.orderBy(F.desc("n_unreviewed"), "plant_id") if ordered else out


def dashboard(warrants: DataFrame, conflicts: DataFrame, claims: DataFrame, batches: DataFrame) -> DataFrame:
    """(counter, key, n) over the tables, one pass each: totals, and counts by type, severity and status.

    Unreviewed warrants are those of the batch that was started last.
    """
    pending = F.col("status") == "pending"
    last = batches.agg(F.max_by("id", F.struct("started_at", "id")).alias("last"))

    def by(df: DataFrame, column: str, name: str, total: str) -> DataFrame:
        sets = df.groupingSets([[], [column]], column).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
        return sets.select(F.when(F.col("g") == 1, total).otherwise(name).alias("counter"), F.when(F.col("g") == 1, "").otherwise(F.coalesce(column, F.lit("null"))).alias("key"), "n")

    singles = [
        conflicts.agg(F.count_if(pending).alias("conflicts_pending"), F.count_if(pending & (F.col("severity") == "critical")).alias("conflicts_critical_pending"), F.count_if(pending & (F.col("conflict_mode") == "internal")).alias("internal_conflicts_pending")),
        claims.agg(F.count_if((F.col("status") == "approved") & ~F.coalesce("pushed_to_production", F.lit(False))).alias("claims_to_sync")),
        warrants.filter("status = 'unreviewed'").join(F.broadcast(last), F.col("batch_id") == F.col("last")).agg(F.count("*").alias("unreviewed_in_latest_batch")),
        batches.agg(F.count_if(F.col("status") == "completed").alias("batches_completed")),
    ]
    flat = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("counter"), F.lit("").alias("key"), F.col(c).alias("n")) for c in p.columns])).alias("x")).select("x.*") for p in singles]
    return reduce(DataFrame.unionByName, [by(warrants, "warrant_type", "warrants_by_type", "warrants"), by(conflicts, "severity", "conflicts_by_severity", "conflicts"), by(claims, "status", "claims_by_status", "claims"), *flat])


def latest_batch(batches: DataFrame) -> DataFrame:
    return batches.withColumn("__r__", F.row_number().over(Window.partitionBy("source_dataset").orderBy(F.desc("started_at"), F.desc("id")))).filter("__r__ = 1").drop("__r__")


def batch_status(batches: DataFrame, k: int = 10) -> DataFrame:
    """Running batches, and the last ``k`` finished ones."""
    done = batches.filter("status <> 'running'").orderBy(F.desc("started_at"), F.desc("id")).limit(k)
    return batches.filter("status = 'running'").unionByName(done)


# Pipeline steps in order.
STEPS = ("matching", "mapping", "enhancing", "classifying", "committing")


NOTES = "struct<currentStep:string,steps:map<string,struct<status:string,detail:string>>>"


def batch_progress(batches: DataFrame) -> DataFrame:
    """(id, current_step, step, state, detail) from the JSON notes {"currentStep", "steps": {name: {"status", "detail"}}};
    unreadable or missing entries are pending."""
    notes = F.from_json("notes", NOTES)
    each = batches.select("id", notes.alias("m"), F.explode(F.array(*map(F.lit, STEPS))).alias("step")).withColumn("s", F.try_element_at("m.steps", F.col("step")))
    return each.select("id", F.coalesce("m.currentStep", F.lit("pending")).alias("current_step"), "step", F.coalesce("s.status", F.lit("pending")).alias("state"), F.col("s.detail").alias("detail"))


def trait_means(data: DataFrame) -> DataFrame:
    x = F.col("var_value").try_cast("double")
    return data.groupBy("taxon_name", "var_name").agg(F.round(F.avg(x) + 1e-9, 2).alias("mean"), F.count(x).alias("n")).filter("n > 0")


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def field_fill(df: DataFrame) -> DataFrame:
    """(column, n_filled, n_rows)."""
    one = df.agg(F.count("*").alias("__n__"), *[F.count_if(F.trim(F.col(f"`{c}`").cast("string")) != "").alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_filled")) for c in df.columns])).alias("x"), F.col("__n__").alias("n_rows")).select("x.*", "n_rows")


def unmapped_columns(long: DataFrame, column_map: DataFrame, samples: int = 5) -> DataFrame:
    """Columns of a long source table (dataset, column, value) without an attribute, with counts and sorted sample values."""
    left = long.filter(F.trim("value") != "").join(column_map.select(F.lower("column").alias("mapped")), F.lower("column") == F.col("mapped"), "left_anti")
    counts = left.groupBy("dataset", "column").agg(F.count("*").alias("n"))
    # A rank with a limit: each task keeps its first few before the shuffle.
    firsts = left.select("dataset", "column", "value").distinct().withColumn("r", F.row_number().over(Window.partitionBy("dataset", "column").orderBy("value"))).filter(F.col("r") <= samples)
    return counts.join(firsts.groupBy("dataset", "column").agg(F.array_sort(F.collect_list("value")).alias("samples")), ["dataset", "column"])


def attribute_sources(source_columns: DataFrame, column_map: DataFrame) -> DataFrame:
    return source_columns.join(column_map.filter("not is_calculated").select(F.lower("column").alias("k"), "attribute_name"), F.lower("column") == F.col("k")).select("attribute_name", "dataset", "column").distinct()


def merge_sources(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source_id", F.lit(s)) for s, df in parts])


def agreement(long: DataFrame) -> DataFrame:
    """Per name and trait of (name, trait, value, source_id): sources, distinct values, whether all agree."""
    return long.groupBy("name", "trait").agg(F.countDistinct("source_id").alias("n_sources"), F.countDistinct("value").alias("n_values")).withColumn("agreed", F.col("n_values") == 1)
