"""Evidence records (warrants): building them from mapped sources, and finding, pairing and classifying conflicts.

Group work is keyed on (entity, attribute) throughout, so one shuffle serves groups, pairs and labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import is_nullish, parse_name
from ..sources.scratch import kept

PAIR = ["plant_id", "attribute_id"]


def bootstrap_warrants(values: DataFrame, entities: DataFrame, attributes: DataFrame, sources: DataFrame, batch_id: str) -> DataFrame:
    """A warrant for each stored value of a known entity and attribute; the value falls back to the source's wording."""
    v = values.drop("attribute_name").alias("v").join(entities.select(F.col("id").alias("e_id"), "genus", "species"), F.col("v.plant_id") == F.col("e_id"))
    v = v.join(attributes.select(F.col("id").alias("a_id"), F.col("name").alias("attribute_name")), F.col("v.attribute_id") == F.col("a_id"))
    extra = [F.col(c).alias(f"source_{to}") for c, to in (("region", "region"), ("notes", "methodology"), ("name", "dataset")) if c in sources.columns]
    v = v.join(sources.select(F.col("id").alias("s_id"), *extra), F.col("v.source_id") == F.col("s_id"), "left")
    carried = [c for c in ("source_region", "source_methodology", "source_dataset") if c in v.columns]
    return v.select(F.sha2(F.concat_ws("|", F.lit("existing"), "v.id"), 256).alias("id"), F.lit("existing").alias("warrant_type"), F.lit("unreviewed").alias("status"), F.col("v.plant_id").alias("plant_id"), F.col("genus").alias("plant_genus"), F.col("species").alias("plant_species"), F.col("v.attribute_id").alias("attribute_id"), "attribute_name", F.coalesce("v.value", "v.source_value").alias("value"), F.col("v.source_value").alias("source_value"), F.col("v.source_id").alias("source_id"), *carried, F.lit("production").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.lit(batch_id).alias("batch_id"))


def apply_mapping(rows: DataFrame, mapping: DataFrame, key: str = "source_row") -> DataFrame:
    """Wide source rows to (key, source_column, source_value, target_attribute_id, value, missed).

    ``mapping``: source_column, mapping_type, target_attribute_id, crosswalk (map). Skipped and untargeted columns and empty
    cells give nothing. A crosswalk is tried as written, then in lower case; a miss keeps the value and is marked.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("source_column"), F.col(f"`{c}`").cast("string").alias("source_value")) for c in rows.columns if c != key])).alias("c")
    long = rows.select(key, cells).select(key, "c.*").filter(F.trim("source_value") != "")
    use = mapping.filter("mapping_type <> 'SKIP' and target_attribute_id is not null")
    joined = long.join(use, "source_column")
    lower = F.transform_keys(F.coalesce("crosswalk", F.create_map().cast("map<string,string>")), lambda k, v: k)
    exact = F.try_element_at(lower, F.col("source_value"))
    loose = F.get(F.transform(F.filter(F.map_entries(lower), lambda e: F.lower(e["key"]) == F.lower(F.col("source_value"))), lambda e: e["value"]), F.lit(0))
    found = F.coalesce(exact, loose)
    return joined.select(key, "source_column", "source_value", "target_attribute_id", F.coalesce(found, F.col("source_value")).alias("value"), (F.col("crosswalk").isNotNull() & found.isNull()).alias("missed"))


def enhance(mapped: DataFrame, names: DataFrame, matches: DataFrame, dataset: str, batch_id: str) -> DataFrame:
    """Warrants of matched source rows. ``names`` (source_row, name), ``matches`` (name_key, plant_id, match_type, confidence).

    One row may match several entities (genus expansion): each gets its warrant.
    """
    m = matches.filter("match_type <> 'NONE' and plant_id is not null")
    joined = mapped.join(names, "source_row").withColumn("name_key", F.lower(F.trim("name"))).join(m, "name_key")
    key = F.concat_ws("|", F.lit(dataset), "source_row", "source_column", "plant_id", "target_attribute_id")
    return joined.select(F.sha2(key, 256).alias("id"), F.lit("external").alias("warrant_type"), F.lit("unreviewed").alias("status"), "plant_id", F.col("target_attribute_id").alias("attribute_id"), "value", "source_value", F.lit(dataset).alias("source_dataset"), "source_row", "source_column", F.col("match_type").alias("match_method"), F.col("confidence").alias("match_confidence"), ((F.col("confidence") < 0.8) | F.col("missed")).alias("flagged"), F.lit(batch_id).alias("batch_id"))


def enhance_stats(warrants: DataFrame, mapped: DataFrame | None = None) -> DataFrame:
    """One row of counts, which a dry run shows without writing the warrants. With the mapped cells also those that gave none, as their
    row matched no entity."""
    out = _enhance_counts(warrants)
    if mapped is None:
        return out
    lost = mapped.join(warrants.select("source_row", "source_column").distinct(), ["source_row", "source_column"], "left_anti").agg(F.count("*").alias("skipped"))
    return out.withColumn("skipped", lost.scalar())


def _enhance_counts(warrants: DataFrame) -> DataFrame:
    return warrants.agg(F.count("*").alias("created"), F.count_if("flagged").alias("flagged"), F.countDistinct("plant_id").alias("entities"), F.countDistinct("attribute_id").alias("attributes"))


def validate_mapping(mapping: DataFrame, attributes: DataFrame) -> DataFrame:
    """Mappings to unknown attributes become UNCERTAIN without a target."""
    known = attributes.select(F.col("id").alias("known_id"))
    out = mapping.join(known, mapping["target_attribute_id"] == known["known_id"], "left")
    lost = F.col("target_attribute_id").isNotNull() & F.col("known_id").isNull()
    return out.withColumn("mapping_type", F.when(lost, "UNCERTAIN").otherwise(F.col("mapping_type"))).withColumn("target_attribute_id", F.when(~lost, F.col("target_attribute_id"))).drop("known_id")


def unmapped_headers(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Columns of a source (source_column) that no mapping names."""
    return headers.select("source_column").distinct().join(mapping.select("source_column"), "source_column", "left_anti")


def mapping_summary(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("mapping_type").agg(F.count("*").alias("n"))


def active(warrants: DataFrame, mode: str | None = None) -> DataFrame:
    """Not excluded (a null status is not active); ``mode`` internal or external keeps one kind."""
    out = warrants.filter("status <> 'excluded'")
    if mode is None:
        return out
    return out.filter(F.col("warrant_type") == ("external" if mode == "external" else "existing"))


def warrant_groups(warrants: DataFrame, mode: str | None = None, min_size: int = 2, entity_ids: list | None = None, attr_like: str | None = None) -> DataFrame:
    """Groups of at least ``min_size`` active warrants, of the listed entities and of attributes whose name holds ``attr_like``, case apart."""
    out = active(warrants, mode)
    if entity_ids:
        out = out.filter(F.col("plant_id").isin(*entity_ids))
    if attr_like:
        out = out.filter(F.lower("attribute_name").contains(attr_like.lower()))
    return out.groupBy(*PAIR).agg(F.count("*").alias("n_warrants")).filter(F.col("n_warrants") >= min_size)


def warrant_groups_page(warrants: DataFrame, limit: int = 50, offset: int = 0, **options) -> tuple[DataFrame, DataFrame]:
    """``limit`` groups from ``offset`` on, the largest first (ids break ties), and one row with the ``total`` of all groups."""
    groups = warrant_groups(warrants, **options)
    return groups.orderBy(F.desc("n_warrants"), *PAIR).offset(offset).limit(limit), groups.agg(F.count("*").alias("total"))


def warrant_group_members(warrants: DataFrame, mode: str | None = None, min_size: int = 2, strict_mode: bool = False, **options) -> DataFrame:
    """All active warrants of the groups that qualify in ``mode``; ``strict_mode`` keeps the mode for members too.

    Groups are counted first and joined back, so that the members of one very large group are split over tasks.
    """
    return active(warrants, mode if strict_mode else None).join(warrant_groups(warrants, mode, min_size, **options), PAIR)


def conflict_pairs(members: DataFrame, threshold: int = 5) -> DataFrame:
    """Pairs (a before b by source and id): all in groups of up to ``threshold``, else the first warrant of the modal value with each other.

    The first rows of every group, one more than ``threshold``, come together in one exchange; a rank with a limit cuts them in each task
    before it. Groups that are whole with these are paired there. Only the others are counted: sizes, modes and anchors are aggregates of
    their rows, equal ones counted once, and an info row of each group (its size, the anchor and its count) is joined to the
    rows, a join that adaptive execution splits when a group is hot. A repeated anchor row is paired with its copies.
    """
    m = members.select(*PAIR, F.struct("source_id", "id", "value").alias("w"))
    first = m.withColumn("r", F.row_number().over(Window.partitionBy(*PAIR).orderBy("w"))).filter(F.col("r") <= threshold + 1)
    groups = first.groupBy(*PAIR).agg(F.sort_array(F.collect_list("w")).alias("all"))
    each = F.transform("all", lambda a, i: F.transform(F.slice("all", i + 2, F.lit(threshold)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    few = groups.filter(F.size("all").between(2, threshold)).select(*PAIR, F.explode(F.flatten(each)).alias("p"))

    big = groups.filter(F.size("all") > threshold).select(*PAIR)
    rows = m.join(big, PAIR, "left_semi").groupBy(*PAIR, F.lower(F.trim("w.value")).alias("v"), "w").agg(F.count("*").alias("c"))
    votes = rows.groupBy(*PAIR, "v").agg(F.sum("c").alias("votes"), F.min(F.struct("w", "c")).alias("first"))
    info = votes.groupBy(*PAIR).agg(F.min(F.struct((-F.col("votes")).alias("votes"), "first"))["first"].alias("anchor"))
    large = rows.select(*PAIR, "w", "c").join(info, PAIR).withColumn("c", F.when(F.col("w") == F.col("anchor.w"), F.col("c") - 1).otherwise(F.col("c"))).filter("c > 0")
    many = large.select(*PAIR, F.struct(F.col("anchor.w").alias("a"), F.col("w").alias("b")).alias("p"), F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("i")).drop("i")
    return few.unionByName(many).select(*PAIR, *[F.col(f"p.{x}.{c}").alias(f"{c}_{x}") for c in ("id", "value", "source_id") for x in ("a", "b")])


def classify_pairs(pairs: DataFrame) -> DataFrame:
    """verdict: corroborated, COMPLETENESS_CONFLICT (exactly one side is missing) or REVIEW; severity minor for the second."""
    equal = F.lower(F.trim("value_a")).eqNullSafe(F.lower(F.trim("value_b")))
    one = is_nullish("value_a") != is_nullish("value_b")
    return pairs.withColumn("verdict", F.when(equal, "corroborated").when(one, "COMPLETENESS_CONFLICT").otherwise("REVIEW")).withColumn("severity", F.when(F.col("verdict") == "COMPLETENESS_CONFLICT", "minor"))


# Conflict types with their default severity and the specialist that reviews them.
CONFLICT_TYPES = {
    "RATING_DISAGREEMENT": ("critical", "ratingConflictFlow"), "SCALE_MISMATCH": ("moderate", "ratingConflictFlow"), "SCOPE_DIFFERENCE": ("moderate", "scopeConflictFlow"), "TEMPORAL_CONFLICT": ("minor", "temporalConflictFlow"),
    "METHODOLOGY_DIFFERENCE": ("moderate", "methodologyConflictFlow"), "GRANULARITY_MISMATCH": ("minor", "taxonomyConflictFlow"), "DEFINITION_CONFLICT": ("moderate", "definitionConflictFlow"), "COMPLETENESS_CONFLICT": ("minor", None),
}
SEVERITIES = ("critical", "moderate", "minor")


def severity_rank(c: str = "severity") -> Column:
    """3 for critical, 2 for moderate, 1 for minor, 0 for others."""
    return F.when(F.col(c) == "critical", 3).when(F.col(c) == "moderate", 2).when(F.col(c) == "minor", 1).otherwise(0)


def finalize_conflicts(pairs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Conflicts of classified pairs, with type, severity and the specialist they go to (none for missing values).

    ``labels`` (id_a, id_b, label, label_severity, each pair once) holds what a reviewer said; without it the pairs have these two
    columns themselves. Unknown types become RATING_DISAGREEMENT, unknown severities the type's own; pairs
    with a missing value keep what the classification gave them, pairs without a label are moderate rating disagreements.
    """
    known = pairs.filter("verdict <> 'corroborated'")
    both = known if labels is None else known.join(labels, ["id_a", "id_b"], "left")
    settled = F.col("verdict") == "COMPLETENESS_CONFLICT"
    kind = F.when(settled, F.col("verdict")).when(F.col("label").isin(*CONFLICT_TYPES), F.col("label")).otherwise("RATING_DISAGREEMENT")
    default = F.create_map(*[F.lit(x) for k, (s, _) in CONFLICT_TYPES.items() for x in (k, s)])
    route = F.create_map(*[F.lit(x) for k, (_, r) in CONFLICT_TYPES.items() if r for x in (k, r)])
    severity = F.when(settled, "minor").when(F.col("label_severity").isin(*SEVERITIES), F.col("label_severity")).when(F.col("label").isNull() & F.col("label_severity").isNull(), "moderate")
    out = both.withColumn("conflict_type", kind).withColumn("severity", F.coalesce(severity, default[F.col("conflict_type")]))
    return out.withColumn("specialist_agent", F.try_element_at(route, F.col("conflict_type"))).drop("label", "label_severity", "verdict")


def conflict_summary(conflicts: DataFrame) -> DataFrame:
    """(dimension, key, n): the total, by severity and by type, in one pass."""
    sets = conflicts.groupingSets([[], ["severity"], ["conflict_type"]], "severity", "conflict_type").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    return sets.select(F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "severity").otherwise("type").alias("dimension"), F.coalesce("severity", "conflict_type", F.lit("all")).alias("key"), "n")


def internal_conflicts(values: DataFrame) -> DataFrame:
    """Pairs of entity and attribute with more than one distinct value."""
    return values.filter("value is not null").groupBy(*PAIR).agg(F.countDistinct("value").alias("n_values"), F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("value_list")).filter("n_values > 1")


def temporal_gap(pairs: DataFrame, years: DataFrame, limit: int = 10) -> DataFrame:
    """``years`` (id, year text): difference, newer side and whether it is over ``limit`` years."""
    y = lambda x: years.select(F.col("id").alias(f"id_{x}"), F.col("year").try_cast("int").alias(f"year_{x}"))
    out = pairs.join(y("a"), "id_a", "left").join(y("b"), "id_b", "left").withColumn("gap", F.abs(F.col("year_a") - F.col("year_b")))
    return out.withColumn("newer", F.when(F.col("year_a") > F.col("year_b"), "a").when(F.col("year_b") > F.col("year_a"), "b")).withColumn("wide", F.coalesce(F.col("gap") > limit, F.lit(False)))


def granularity(name_a: Column | str, name_b: Column | str) -> Column:
    """Whether one side speaks of a genus and the other of a species."""
    return parse_name(name_a)["is_genus_only"] != parse_name(name_b)["is_genus_only"]


def scope_flag(region_a: Column | str, region_b: Column | str, targets: list[str]) -> Column:
    def inside(c):
        hit = F.lit(False)
        for t in targets:
            hit = hit | F.lower(F.col(c) if isinstance(c, str) else c).contains(t.lower())
        return hit

    a, b = inside(region_a), inside(region_b)
    return F.when(a.isNull() | b.isNull(), "unknown").when(a == b, "same").otherwise("disjoint")


def apply_verdicts(conflicts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Merge (id, verdict, recommendation); conflicts that got one are annotated."""
    v = verdicts.select("id", F.col("verdict").alias("v"), F.col("recommendation").alias("r"))
    return conflicts.join(v, "id", "left").withColumns({"specialist_verdict": F.coalesce("v", "specialist_verdict"), "specialist_recommendation": F.coalesce("r", "specialist_recommendation"), "status": F.when(F.col("v").isNotNull(), "annotated").otherwise(F.col("status"))}).drop("v", "r")


def set_status(df: DataFrame, ids: DataFrame, status: str, allowed: tuple[str, ...]) -> DataFrame:
    if status not in allowed:
        raise ValueError(f"unknown status {status}")
    marked = ids.select(F.col("id")).distinct().withColumn("__hit__", F.lit(True))
    return df.join(marked, "id", "left").withColumn("status", F.when(F.col("__hit__"), F.lit(status)).otherwise(F.col("status"))).drop("__hit__")


def default_verdicts(conflicts: DataFrame) -> DataFrame:
    """Human review for methodology and definition conflicts: both sides' method and the first 1,500 characters of their data
    dictionaries (columns source_methodology_a / _b and dictionary_a / _b, where there are any)."""
    out = conflicts.filter(F.col("conflict_type").isin("METHODOLOGY_DIFFERENCE", "DEFINITION_CONFLICT"))
    side = lambda x: (F.coalesce(F.col(f"source_{x}"), F.lit("Unknown")), F.coalesce(F.col(f"source_methodology_{x}") if f"source_methodology_{x}" in conflicts.columns else F.lit(None), F.lit("Unknown")), F.substring(F.coalesce(F.col(f"dictionary_{x}") if f"dictionary_{x}" in conflicts.columns else F.lit(None), F.lit("No data dictionary available.")), 1, 1500))
    (a, method_a, text_a), (b, method_b, text_b) = side("a"), side("b")
    what = F.when(F.col("conflict_type") == "DEFINITION_CONFLICT", "Definition").otherwise("Methodology")
    text = F.concat(what, F.lit(" conflict requires human review. Source A ("), a, F.lit(") methodology: "), method_a, F.lit(". Source B ("), b, F.lit(") methodology: "), method_b, F.lit(".\n\n--- Source A Data Dictionary ---\n"), text_a, F.lit("\n\n--- Source B Data Dictionary ---\n"), text_b)
    return out.select("id", F.lit("NUANCED").alias("verdict"), F.lit("HUMAN_DECIDE").alias("recommendation"), F.lit(0.0).alias("confidence"), text.alias("analysis"))


def resolution_queue(conflicts: DataFrame) -> DataFrame:
    """``priority`` 1 to 6: critical internal, critical external, moderate internal, moderate external, minor, cross-source of any
    severity; ids break ties."""
    mode, severity = F.col("conflict_mode"), F.col("severity")
    priority = F.when(~F.coalesce(mode.isin("internal", "external"), F.lit(False)), 6)
    for i, (s, m) in enumerate((("critical", "internal"), ("critical", "external"), ("moderate", "internal"), ("moderate", "external")), 1):
        priority = priority.when((severity == s) & (mode == m), i)
    return conflicts.withColumn("priority", priority.otherwise(5)).orderBy("priority", "id")


def _disagreeing(values: DataFrame) -> DataFrame:
    """Pairs on which more than one source gives more than one value: the least and the greatest of each differ."""
    named = values.filter("source_id is not null")
    ends = named.groupBy(*PAIR).agg(*[f(c).alias(f"{n}_{c}") for c in ("value", "source_id") for n, f in (("least", F.min), ("most", F.max))])
    return ends.filter("least_value < most_value and least_source_id < most_source_id").select(*PAIR)


def audit_disagreements(values: DataFrame) -> DataFrame:
    """Values with a source of pairs on which more than one source gives more than one value."""
    return values.filter("source_id is not null").join(_disagreeing(values), PAIR, "left_semi")


def _allowed() -> Column:
    """The names of an attribute's allowed list, in lower case."""
    allowed = F.from_json("values_allowed", "array<struct<id:string,displayName:string>>")
    return F.filter(F.transform(allowed, lambda a: F.lower(F.trim(F.coalesce(a["displayName"], a["id"], F.lit(""))))), lambda x: x != "")


def audit_values(values: DataFrame, attributes: DataFrame) -> DataFrame:
    """Values outside the attribute's allowed list (JSON; an entry's displayName counts, its id only where it has none), with the list as
    text (allowed_set); blank values and attributes without a readable list pass."""
    ok = attributes.select(F.col("id").alias("attribute_id"), _allowed().alias("names")).filter(F.size(F.coalesce("names", F.array())) > 0)
    v = F.lower(F.trim("value"))
    return values.join(ok, "attribute_id").filter((v != "") & ~F.array_contains("names", v)).withColumn("allowed_set", F.array_join("names", ", ")).drop("names")


# What an audit warrant says about its scan.
MISSING_SOURCE = "Missing provenance: value has no source_id"


def _failure(value: Column | str, allowed: Column | str) -> Column:
    return F.concat(F.lit('Value validation failure: "'), value, F.lit('" not in allowed set ['), allowed, F.lit("]"))


def run_audit(values: DataFrame, attributes: DataFrame, existing: DataFrame, entities: DataFrame | None = None, batch_id: str = "audit") -> DataFrame:
    """New audit warrants (id, warrant_type, status, plant_id, attribute_id, attribute_name, value, source_id, source_dataset,
    source_id_code, batch_id, notes, scan): each key (pair and value) once, by the first scan that finds it and there by the least source.

    Scans: disagreeing sources, values outside the allowed list, no source. Keys of ``existing`` warrants are left out, as are
    values of unknown attributes and, where ``entities`` are given, unknown entities. A null value counts as a value of its own.
    One row a pair and value goes through the shuffles, and the pairs' other values are looked at where an entity's rows have come together.
    """
    name, names = F.min(F.struct("name"))["name"].alias("attribute_name"), F.collect_set(F.when(F.size(_allowed()) > 0, _allowed())).alias("lists")
    attrs = kept(attributes.groupBy(F.col("id").alias("attribute_id")).agg(name, names))
    rows = values.select(*PAIR, "value", "source_id", F.col("source_id").isNull().alias("missing"), F.lit(False).alias("old"))
    rows = rows.unionByName(existing.select(*PAIR, "value", F.lit(None).cast("string").alias("source_id"), F.lit(False).alias("missing"), F.lit(True).alias("old")))
    each = rows.join(attrs.select("attribute_id"), "attribute_id", "left_semi").groupBy(*PAIR, "value").agg(F.min("source_id").alias("least"), F.max("source_id").alias("most"), F.max("missing").alias("missing"), F.max("old").alias("old"))
    if entities is not None:
        each = each.join(entities.select(F.col("id").alias("plant_id")), "plant_id", "left_semi")
    pair, named = Window.partitionBy(*PAIR), F.when(F.col("least").isNotNull(), F.col("value"))
    disagree = F.coalesce((F.min(named).over(pair) < F.max(named).over(pair)) & (F.min("least").over(pair) < F.max("most").over(pair)), F.lit(False))
    v = F.lower(F.trim("value"))
    failed = F.array_min(F.transform(F.filter("lists", lambda x: (v != "") & ~F.array_contains(x, v)), lambda x: F.array_join(x, ", ")))
    each = each.withColumn("disagree", disagree).join(attrs, "attribute_id").withColumn("failed", failed)
    # Of a value's scans the first; an outside value without a source comes before those with one.
    scan = F.when(F.col("disagree") & F.col("least").isNotNull(), 1).when(F.col("failed").isNotNull() & (F.col("missing") | F.col("least").isNotNull()), 2).when(F.col("missing"), 3)
    notes = F.when(F.col("scan") == 2, _failure("value", "failed")).when(F.col("scan") == 3, MISSING_SOURCE)
    source = F.when((F.col("scan") == 1) | ~F.col("missing"), F.col("least"))
    found = each.withColumn("scan", scan).select(*PAIR, F.coalesce("value", F.lit("null")).alias("key"), "old", F.when(F.col("scan").isNotNull(), F.struct("scan", source.alias("source_id"), "attribute_name", "value", notes.alias("notes"))).alias("f"))
    new = found.groupBy(*PAIR, "key").agg(F.min("f").alias("f"), F.max("old").alias("old")).filter("not old and f is not null")
    new = new.select(*[F.col(c).cast(values.schema[c].dataType).alias(c) for c in PAIR], "key", "f")
    return new.select(
        F.sha2(F.concat_ws("|", F.lit(batch_id), *PAIR, "key"), 256).alias("id"), F.lit("internal_audit").alias("warrant_type"), F.lit("unreviewed").alias("status"), *PAIR, F.col("f.attribute_name").alias("attribute_name"),
        F.when(F.col("f.scan") == 3, F.coalesce("f.value", F.lit(""))).otherwise(F.col("f.value")).alias("value"), F.col("f.source_id").alias("source_id"), F.lit("production").alias("source_dataset"), F.lit("INTERNAL_AUDIT").alias("source_id_code"), F.lit(batch_id).alias("batch_id"), F.col("f.notes").alias("notes"), F.col("f.scan").alias("scan"),
    )


def audit_conflicts(new: DataFrame, batch_id: str = "audit") -> DataFrame:
    """One conflict for each pair with two new warrants of the first scan: its first two by source and value."""
    side = F.struct("source_id", F.coalesce("value", F.lit("null")).alias("k"), "id", "value", "attribute_name")
    # A rank with a limit cuts a pair of very many values in each task, before a shuffle.
    rank = F.dense_rank().over(Window.partitionBy(*PAIR).orderBy("source_id", F.coalesce("value", F.lit("null")), "id"))
    two = new.filter("scan = 1").withColumn("r", rank).filter("r <= 2").groupBy(*PAIR).agg(F.min(side).alias("a"), F.max(side).alias("b"), F.max("r").alias("n")).filter("n > 1")
    fixed = {"conflict_type": "value_disagreement", "conflict_mode": "internal", "severity": "moderate", "status": "pending", "batch_id": batch_id, "classifier_explanation": "Internal audit: multiple sources disagree on value"}
    return two.select(*PAIR, F.col("a.attribute_name").alias("attribute_name"), *[F.lit(v).alias(k) for k, v in fixed.items()], *[F.col(f"{x}.{c}").alias(f"{n}_{x}") for x in ("a", "b") for n, c in (("warrant_id", "id"), ("value", "value"), ("source", "source_id"))])


def audit_results(new: DataFrame, conflicts: DataFrame, values: DataFrame, entities: DataFrame | None = None, attributes: DataFrame | None = None) -> DataFrame:
    """One row of counts: groups of known entities and attributes that disagree, and what the run found and made."""
    if attributes is not None:
        values = values.join(kept(attributes.select(F.col("id").alias("attribute_id")).distinct()), "attribute_id", "left_semi")
    groups = _disagreeing(values)
    if entities is not None:
        groups = groups.join(entities.select(F.col("id").alias("plant_id")), "plant_id", "left_semi")
    groups = groups.agg(F.count("*").alias("disagreements_found"))
    made = new.agg(F.count_if(F.col("scan") == 2).alias("validation_failures"), F.count_if(F.col("scan") == 3).alias("missing_provenance"), F.count("*").alias("warrants_created"))
    n = conflicts.agg(F.count("*").alias("n"))
    return made.withColumn("disagreements_found", groups.scalar()).withColumn("conflicts_created", n.scalar())


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Rows whose key names no parent."""
    return children.join(parents.select(F.col(parent_key).alias("__p__")), F.col(child_key) == F.col("__p__"), "left_anti")


def evidence_bundle(conflicts: DataFrame, warrants: DataFrame, docs: DataFrame | None = None, nodes: DataFrame | None = None, k: int = 5, attributes: DataFrame | None = None) -> DataFrame:
    """Both sides' provenance beside each conflict, the start of both sources' documents, and the ``k`` best sections of the index.

    ``docs`` (source_dataset, dictionary, readme): 3,000 and 2,000 characters are kept. ``nodes`` (doc_id, node_id, title, summary)
    are searched for the attribute's name, once for each distinct name: those of ``attributes`` (name) where they are given, so that the
    conflicts are not worked out once more for their names, else those of the conflicts.
    """
    cols = [c for c in ("source_methodology", "source_region", "source_year", "source_dataset") if c in warrants.columns]
    side = lambda x: warrants.select(F.col("id").alias(f"warrant_{x}_id"), *[F.col(c).alias(f"{c}_{x}") for c in cols])
    out = conflicts.join(side("a"), "warrant_a_id", "left").join(side("b"), "warrant_b_id", "left")
    if docs is not None:
        for x in ("a", "b"):
            out = out.join(docs.select(F.col("source_dataset").alias(f"source_dataset_{x}"), F.substring("dictionary", 1, 3000).alias(f"dictionary_{x}"), F.substring("readme", 1, 2000).alias(f"readme_{x}")), f"source_dataset_{x}", "left")
    if nodes is not None:
        from .docindex import search_nodes

        named = conflicts.select("attribute_name") if attributes is None else attributes.select(F.col("name").alias("attribute_name"))
        asked = named.select(F.col("attribute_name").alias("query_id"), F.col("attribute_name").alias("query")).filter("query is not null").distinct()
        hits = search_nodes(nodes, asked, k).join(nodes.select("doc_id", "node_id", "title", "summary"), ["doc_id", "node_id"])
        top = hits.groupBy(F.col("query_id").alias("attribute_name")).agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "node_id", "title", "summary"))).alias("sections"))
        # Written, so that its size is known: a row an attribute meets the conflicts in their own tasks.
        out = out.join(kept(top), "attribute_name", "left")
    return out
