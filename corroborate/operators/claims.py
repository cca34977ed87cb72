"""Reliability scores, consensus claims, sync to the store, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import infer_currency, infer_methodology, infer_specificity
from ..sources import scratch
from .evidence import PAIR

# The parts of the reliability score; unknown values count as the default after each table.
METHOD = {"meta_analysis": 1.0, "experimental": 0.9, "field_observation": 0.7, "literature_review": 0.6, "modeling": 0.5, "expert_opinion": 0.4}
GEO = {"local": 1.0, "regional": 0.8, "national": 0.5, "global": 0.3}
CURRENCY = {"current": 1.0, "recent": 0.7, "dated": 0.4}


def _points(c: str, table: dict[str, float]) -> Column:
    out = F.lit(0.5)
    for k, v in table.items():
        out = F.when(F.col(c) == k, F.lit(v)).otherwise(out)
    return out


def auto_score(df: DataFrame) -> DataFrame:
    """0.30 method + 0.20 peer review + 0.15 sample + 0.20 geography + 0.15 currency, two places.

    All digits of the sample size are read as one number, so "1,200" is 1200.
    """
    size = F.regexp_replace("sample_size", "[^0-9]", "").try_cast("double")
    sample = F.when(size > 1000, 1.0).when(size >= 100, 0.7).when(size.isNotNull(), 0.4).otherwise(0.5)
    peer = F.when(F.col("peer_reviewed"), 1.0).otherwise(0.3)
    score = 0.30 * _points("methodology_type", METHOD) + 0.20 * peer + 0.15 * sample + 0.20 * _points("geographic_specificity", GEO) + 0.15 * _points("temporal_currency", CURRENCY)
    # The small addend makes sums that stand for a half round up whatever their binary form.
    return df.withColumn("auto_score", F.round(score + 1e-9, 2))


def seed_reliability(warrants: DataFrame, existing: DataFrame, as_of_year: int) -> DataFrame:
    """Scores of sources that have none, from each source's latest metadata."""
    last = warrants.filter("source_id is not null").groupBy("source_id").agg(F.max_by(F.struct("source_methodology", "source_region", "source_year"), F.struct("created_at", "id")).alias("m"))
    new = last.join(existing.select("source_id"), "source_id", "left_anti")
    return auto_score(new.select("source_id", infer_methodology("m.source_methodology").alias("methodology_type"), F.lit(False).alias("peer_reviewed"), F.lit(None).cast("string").alias("sample_size"), infer_specificity("m.source_region").alias("geographic_specificity"), infer_currency("m.source_year", as_of_year).alias("temporal_currency"))).withColumn("reliability_score", F.col("auto_score"))


def rescore(rel: DataFrame) -> DataFrame:
    """The automatic score of every source anew; the score in use (``reliability_score``), which a steward may have set, stays."""
    return auto_score(rel)


def update_reliability(rel: DataFrame, patch: DataFrame, by: str = "admin") -> DataFrame:
    """Patched columns where the patch has a value, and who patched the row. Neither score follows a patch of other columns by
    itself: ``rescore`` gives the automatic one, and a patch of ``reliability_score`` is the steward's override."""
    cols = [c for c in patch.columns if c != "source_id"]
    p = patch.select("source_id", *[F.col(c).alias(f"__{c}") for c in cols], F.lit(True).alias("__hit__"))
    out = rel.join(p, "source_id", "left")
    changed = {c: F.coalesce(f"__{c}", c) for c in cols}
    changed["updated_by"] = F.when(F.col("__hit__"), F.lit(by)).otherwise(F.col("updated_by") if "updated_by" in rel.columns else F.lit(None))
    return out.withColumns(changed).drop("__hit__", *[f"__{c}" for c in cols])


def against_warrants(conflicts: DataFrame) -> DataFrame:
    """(id): warrants that a specialist's recommendation on a conflict which is not dismissed prefers the other one to."""
    c = conflicts.filter("status <> 'dismissed'")
    a = c.filter("specialist_recommendation = 'PREFER_B'").select(F.col("warrant_a_id").alias("id"))
    return a.union(c.filter("specialist_recommendation = 'PREFER_A'").select(F.col("warrant_b_id").alias("id"))).filter("id is not null").distinct()


def consensus_claims(warrants: DataFrame, reliability: DataFrame, default: float = 0.5, conflicts: DataFrame | None = None, against: float = 0.5) -> DataFrame:
    """Per pair the value with the largest sum of reliabilities (then the smaller text), its share and a confidence band.

    Bands are our own rule: high from 0.75 with two sources, moderate from 0.5, else low. So is the weight of warrants that specialists
    prefer others to (``against_warrants`` of ``conflicts``): ``against`` of what it would be.
    """
    w = warrants.filter("status <> 'excluded' and value is not null").join(reliability.select("source_id", "reliability_score"), "source_id", "left")
    score = F.coalesce("reliability_score", F.lit(default))
    if conflicts is not None:
        w = w.join(against_warrants(conflicts).withColumn("less", F.lit(against)), "id", "left")
        score = score * F.coalesce("less", F.lit(1.0))
    per = w.groupBy(*PAIR, F.lower(F.trim("value")).alias("value")).agg(F.sum(score.cast("decimal(10,4)")).alias("weight"), F.countDistinct("source_id").alias("n_sources"), F.count("*").alias("n"))
    # Weights are decimals, so that the order of a sum does not decide. One aggregate picks the winner, without a window.
    best = per.groupBy(*PAIR).agg(F.min(F.struct((-F.col("weight")).alias("w"), (-F.col("n")).alias("c"), "value", "n_sources")).alias("b"), F.sum("weight").alias("total"), F.sum("n").alias("warrant_count"))
    share = F.round((-F.col("b.w")).cast("double") / F.col("total").cast("double") + 1e-9, 4)
    return best.select(*PAIR, "b.value", share.alias("support"), "warrant_count", F.when((share >= 0.75) & (F.col("b.n_sources") >= 2), "high").when(share >= 0.5, "moderate").otherwise("low").alias("confidence"))


def validate_categorical(df: DataFrame, attributes: DataFrame) -> DataFrame:
    """``valid``: the value is in the attribute's comma list, case apart; attributes without a list accept all."""
    a = attributes.select(F.col("id").alias("attribute_id"), F.transform(F.split("values_allowed", ","), lambda x: F.lower(F.trim(x))).alias("ok"))
    return df.join(a, "attribute_id", "left").withColumn("valid", F.col("ok").isNull() | F.array_contains("ok", F.lower(F.trim("value")))).drop("ok")


def build_claims(consensus: DataFrame, warrants: DataFrame, reliability: DataFrame | None = None, default: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Claims with ids from their pair and value, and the claim-warrant rows.

    Warrants of the claimed value are primary, others contextual. With ``reliability`` only those of the most reliable source that has the
    value (of equal ones all) drive the claim; the others of that value are supporting.
    """
    claims = consensus.withColumn("id", F.sha2(F.concat_ws("|", *PAIR, "value"), 256)).withColumn("status", F.lit("draft"))
    links = warrants.filter("status <> 'excluded'").join(claims.select(*PAIR, F.col("id").alias("claim_id"), F.col("value").alias("claimed")), PAIR)
    agrees = F.coalesce(F.lower(F.trim("value")) == F.col("claimed"), F.lit(False))
    reason = F.when(agrees, "primary").otherwise("contextual")
    if reliability is not None:
        links = links.join(reliability.select("source_id", F.col("reliability_score").alias("score")), "source_id", "left").withColumn("score", F.coalesce("score", F.lit(default)))
        best = links.filter(agrees).groupBy("claim_id").agg(F.max("score").alias("best"))
        links = links.join(best, "claim_id", "left")
        reason = F.when(agrees & (F.col("score") < F.col("best")), "supporting").otherwise(reason)
    return claims, links.select("claim_id", F.col("id").alias("warrant_id"), reason.alias("inclusion_reason"))


def syncable_claims(claims: DataFrame) -> DataFrame:
    return claims.filter("status = 'approved' and not coalesce(pushed_to_production, false)").withColumn("new_value", F.coalesce("edited_value", "categorical_value", "synthesized_text"))


def current_values(values: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct values of the wanted pairs, sorted and joined by ', '."""
    return values.join(pairs.select(*PAIR).distinct(), PAIR, "left_semi").filter("value is not null").groupBy(*PAIR).agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("current_value"))


def later_warrants(claims: DataFrame, warrants: DataFrame) -> DataFrame:
    """(claim_id, warrant_id, value, source_id, created_at): evidence not excluded that came after an approved claim on its pair."""
    c = claims.filter("status = 'approved'").select(F.col("id").alias("claim_id"), *PAIR, "approved_at")
    w = warrants.filter("status <> 'excluded'").select(*PAIR, F.col("id").alias("warrant_id"), "value", "source_id", "created_at")
    return c.join(w, PAIR).filter("created_at > approved_at").drop(*PAIR, "approved_at")


def stale_claims(claims: DataFrame, warrants: DataFrame) -> DataFrame:
    """(claim_id, n_later): approved claims with later evidence that is not excluded."""
    return later_warrants(claims, warrants).groupBy("claim_id").agg(F.count("*").alias("n_later"))


def sync_preview(claims: DataFrame, values: DataFrame, warrants: DataFrame) -> DataFrame:
    c = syncable_claims(claims)
    stale = stale_claims(c, warrants).select(F.col("claim_id").alias("id"), "n_later")
    return c.join(current_values(values, c), PAIR, "left").join(stale, "id", "left").withColumn("is_stale", F.col("n_later").isNotNull())


def push_set(preview: DataFrame, ids: DataFrame | None = None, include_stale: bool = False) -> DataFrame:
    out = preview if include_stale else preview.filter("not is_stale")
    return out if ids is None else out.join(ids.select("id").distinct(), "id", "left_semi")


def upsert_values(values: DataFrame, claims: DataFrame) -> DataFrame:
    """The store after syncing (claims: PAIR, new_value, approved_at, id): the least row id of each pair is updated, or a row is
    added; of several claims for a pair the last approved counts. ``action`` is updated, inserted or kept."""
    last = claims.groupBy(*PAIR).agg(F.max_by("new_value", F.struct("approved_at", "id")).alias("new_value"))
    # Written, so that their size is known: where claims are few beside the store, its rows meet them in their own tasks.
    last = scratch.kept(last)
    first = values.join(last.select(*PAIR), PAIR, "left_semi").groupBy(*PAIR).agg(F.min("id").alias("id"), F.lit(True).alias("stored"))
    target = scratch.kept(last.join(first, PAIR, "left"))
    update = target.filter("stored").select("id", F.col("new_value").alias("__new__"))
    kept = values.join(update, "id", "left").withColumn("action", F.when(F.col("__new__").isNotNull(), "updated").otherwise("kept")).withColumn("value", F.coalesce("__new__", "value")).drop("__new__")
    fresh = target.filter("stored is null").select(F.concat_ws("-", F.lit("new"), *PAIR).alias("id"), *PAIR, F.col("new_value").alias("value"), F.lit("inserted").alias("action"))
    return kept.unionByName(fresh, allowMissingColumns=True)


def mark_pushed(claims: DataFrame, ids: DataFrame) -> DataFrame:
    hit = ids.select("id").distinct().withColumn("__hit__", F.lit(True))
    return claims.join(hit, "id", "left").withColumns({"pushed_to_production": F.coalesce("__hit__", "pushed_to_production"), "status": F.when(F.col("__hit__"), "pushed").otherwise(F.col("status"))}).drop("__hit__")


def batch_record(pushed: DataFrame, batch_id: str, commit: str | None = None) -> DataFrame:
    """The one row that logs a push of these claims (``id``; repeated ids count once); none where nothing was pushed."""
    n = F.count_distinct("id").alias("claims_generated")
    fixed = {"id": batch_id, "source_dataset": "production", "source_id_code": "SYNC", "batch_type": "production_sync", "status": "completed"}
    note = F.concat(F.lit("Pushed "), F.col("claims_generated"), F.lit(" claim(s) to production")).alias("notes")
    return pushed.agg(n).filter("claims_generated > 0").select(*[F.lit(v).alias(k) for k, v in fixed.items()], "claims_generated", note, F.lit(commit).cast("string").alias("dolt_commit_hash"))


def _aligned(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of either; one that a side lacks is null there."""
    cols = [*keys, *[c for c in old.columns if c not in keys], *[c for c in new.columns if c not in keys and c not in old.columns]]
    kinds = {**dict(new.dtypes), **dict(old.dtypes)}
    return tuple(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in cols]) for df in (old, new))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change, old, new): added, modified and removed rows. The columns of either side are compared; nulls, in keys too, equal each other."""
    old, new = _aligned(old, new, keys)
    cols = [c for c in old.columns if c not in keys]
    side = lambda df, p: df.select(*[F.col(k).alias(f"{p}_{k}") for k in keys], F.struct(*cols).alias(p))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}"))
    j = side(old, "old").join(side(new, "new"), on, "full").filter("not (old <=> new)")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("modified")
    return j.select(*[F.coalesce(f"old_{k}", f"new_{k}").alias(k) for k in keys], change.alias("change"), "old", "new")


def range_bounds(df: DataFrame, key: str, n: int, sample: int = 10_000) -> list:
    """Up to ``n`` - 1 bounds that cut a table into ranges of about equal size, from a sample of at most ``sample`` keys, picked by hash."""
    keys = df.select(key).filter(F.col(key).isNotNull())
    # One key in so many is looked at, so that only these are shuffled to be told apart.
    one_in = max(1, keys.agg(F.approx_count_distinct(key)).first()[0] // (2 * sample))
    some = keys.filter(F.pmod(F.xxhash64(key), F.lit(one_in)) == 0).distinct().orderBy(F.xxhash64(key)).limit(sample)
    some = sorted(r[0] for r in some.collect())
    return sorted({some[len(some) * i // n] for i in range(1, n)}) if some else []


def write_snapshot(df: DataFrame, path: str, keys: list[str], bounds: list) -> None:
    """A snapshot in one folder a range of its first key, with a table of digests beside it: rows and two sums of hashes for each range.

    Snapshots that are to be compared are written with the same bounds. Each task writes a file for each range that it has rows of: the rows are
    not shuffled to bring a range's together.
    """
    spread = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(keys[0]))) if bounds else F.lit(0)
    df.withColumn("__range__", F.coalesce(spread, F.lit(0))).write.partitionBy("__range__").parquet(f"{path}/rows")
    back = df.sparkSession.read.parquet(f"{path}/rows")
    cols = sorted(df.columns)
    # A column that is null everywhere adds nothing, so that a column which only one side has changes a digest where it has values.
    cell = lambda c, seed: F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c), F.lit(seed))).otherwise(0)
    row = lambda seed: F.xxhash64(F.array_sort(F.filter(F.array(*[cell(c, seed) for c in cols]), lambda x: x != 0)))
    back.groupBy(F.col("__range__").alias("range")).agg(F.count("*").alias("n"), *[F.sum(row(s).cast("decimal(38,0)")).alias(f"digest_{s}") for s in (1, 2)]).write.parquet(f"{path}/digests")


def stored_diff(spark, old_path: str, new_path: str, keys: list[str]) -> DataFrame:
    """``snapshot_diff`` of two stored snapshots: digests are compared first, and only ranges that differ are read and joined.

    The list of ranges that differ reaches the driver; there are as many ranges as bounds. Ranges that one side lacks differ.
    """
    digests = [spark.read.parquet(f"{p}/digests") for p in (old_path, new_path)]
    names = ("n", "digest_1", "digest_2")
    both = digests[0].select("range", F.struct(*names).alias("a")).join(digests[1].select("range", F.struct(*names).alias("b")), "range", "full")
    differing = [r["range"] for r in both.filter("not (a <=> b)").select("range").collect()]
    sides = [spark.read.parquet(f"{p}/rows").filter(F.col("__range__").isin(*differing) if differing else F.lit(False)).drop("__range__") for p in (old_path, new_path)]
    return snapshot_diff(*sides, keys)


def snapshot_log(log: DataFrame) -> DataFrame:
    """Commits, newest first, with the one before as parent. The log is one row a snapshot."""
    return log.withColumn("parent", F.lag("snapshot_id").over(Window.partitionBy("table").orderBy("committed_at", "snapshot_id"))).orderBy(F.desc("committed_at"), F.desc("snapshot_id"))


def revertible(log: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` latest snapshots; only these may be undone."""
    return log.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(k)


def revert(current: DataFrame, diff: DataFrame, keys: list[str], log: DataFrame | None = None, snapshot=None) -> DataFrame:
    """The current rows with one snapshot's diff undone; ``conflict`` marks rows that changed again since, which stay as they are.

    Added rows go, removed ones come back, modified ones get their old columns. With ``log`` and ``snapshot`` the snapshot has to
    be among the five latest, else this raises.
    """
    if log is not None and revertible(log).filter(F.col("snapshot_id") == F.lit(snapshot)).isEmpty():
        raise ValueError(f"{snapshot} is not one of the five latest snapshots")
    cols = [c for c in current.columns if c not in keys]
    d = diff.select(*[F.col(k).alias(f"__{k}") for k in keys], "change", "old", "new")
    now = current.select(*keys, F.struct(*cols).alias("now"))
    j = now.join(d, [F.col(k) == F.col(f"__{k}") for k in keys], "full")
    # What the snapshot left has to be what is there: its new row, or none where it removed one. A row that is already as it was is no conflict.
    conflict = F.col("change").isNotNull() & ~F.col("now").eqNullSafe(F.col("new")) & ~F.col("now").eqNullSafe(F.col("old"))
    then = F.when(F.col("change").isNull() | conflict, F.col("now")).otherwise(F.col("old"))
    out = j.select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], then.alias("then"), conflict.alias("conflict")).filter("then is not null")
    return out.select(*keys, *[F.col(f"then.{c}").alias(c) for c in cols], "conflict")


def verify_run(warrants: DataFrame, conflicts: DataFrame) -> DataFrame:
    """(check, n): rows, nulls in required fields, conflicts by type and severity where they have these, conflicts that lack either warrant."""
    w = warrants.agg(F.count("*").alias("warrants"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("id", "plant_id", "attribute_id")])
    ids = warrants.select(F.col("id").alias("wid"))
    has = lambda x: ids.distinct().select(F.col("wid").alias(f"has_{x}"))
    sides = conflicts.join(has("a"), F.col("id_a") == F.col("has_a"), "left").join(has("b"), F.col("id_b") == F.col("has_b"), "left")
    lost = sides.filter("has_a is null or has_b is null").agg(F.count("*").alias("n")).select(F.lit("orphan_conflicts").alias("check"), "n")
    out = w.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in w.columns])).alias("x")).select("x.*").unionByName(lost)
    for c in ("conflict_type", "severity"):
        if c in conflicts.columns:
            out = out.unionByName(conflicts.groupBy(F.concat(F.lit(f"{c}_"), F.coalesce(c, F.lit("null"))).alias("check")).agg(F.count("*").alias("n")))
    return out

