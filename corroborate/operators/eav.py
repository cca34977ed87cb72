"""The entity-attribute-value store: selection, presets, gaps, coverage, attribute tree, pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .grams import containing


def few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A one-row table with one array column; raises in the task where the array is longer than ``most``."""
    c = df.columns[0]
    return df.select(F.when(F.size(c) <= most, F.col(c)).otherwise(F.raise_error(F.lit(f"more than {most} {c}"))).alias(c))


def accepted_species(names: DataFrame) -> DataFrame:
    return names.filter((F.lower("taxon_status") == "accepted") & (F.lower("taxon_rank") == "species"))


def with_label(df: DataFrame, column: str, labels: dict[str, str], default: str) -> DataFrame:
    m = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return df.withColumn(f"{column}_label", F.coalesce(F.try_element_at(m, F.col(column)), F.lit(default)))


def search_entities(df: DataFrame, term: str) -> DataFrame:
    hit = F.lower(F.concat_ws(" ", "genus", "species")).contains(term.lower()) | F.lower(F.coalesce("common_name", F.lit(""))).contains(term.lower())
    return df.filter(hit)


def drop_markers(values: DataFrame) -> DataFrame:
    empty = F.coalesce(F.col("value") == "", F.lit(True)) & F.coalesce("source_value", F.lit("")).isin("", "x")
    return values.filter(~empty)


def effective_value(values: DataFrame) -> DataFrame:
    return values.withColumn("value", F.coalesce("value", "source_value"))


def entities_with(values: DataFrame, attribute, wanted: list[str]) -> DataFrame:
    return values.filter((F.col("attribute_id") == attribute) & F.col("value").isin(*wanted)).select("plant_id").distinct()


def values_bulk(values: DataFrame, attribute_ids: DataFrame, entity_ids: DataFrame | None = None) -> DataFrame:
    out = values.join(attribute_ids.select("attribute_id").distinct(), "attribute_id", "left_semi")
    return out if entity_ids is None else out.join(entity_ids.select("plant_id").distinct(), "plant_id", "left_semi")


def preset_rows(presets: DataFrame, fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From JSON specs {category: {field: [values], "matchMode": …}, "heightRange": {"min", "max"}} (columns preset, filters) to
    (preset, attribute_id, value) for ``apply_presets`` and (preset, low, high). ``fields`` maps (category, field) to attribute_id.

    matchMode all, the only one in use, is how presets are matched anyway; a field without an attribute is dropped.
    """
    text = lambda path: F.get_json_object("filters", path)
    bounds = presets.select("preset", text("$.heightRange.min").try_cast("double").alias("low"), text("$.heightRange.max").try_cast("double").alias("high")).filter("low is not null or high is not null")
    tops = presets.select("preset", F.explode(F.from_json("filters", "map<string,string>")).alias("category", "inner")).filter("category <> 'heightRange'")
    each = tops.select("preset", "category", F.explode(F.from_json("inner", "map<string,string>")).alias("field", "list")).filter("field <> 'matchMode'")
    values = each.select("preset", "category", "field", F.explode(F.from_json("list", "array<string>")).alias("value"))
    return values.join(fields, ["category", "field"]).select("preset", "attribute_id", "value"), bounds


def within_heights(matched: DataFrame, bounds: DataFrame, heights: DataFrame) -> DataFrame:
    """Rows of (preset, plant_id) whose height (plant_id, height as text; the first number counts) lies within the preset's bounds."""
    h = heights.select("plant_id", F.regexp_extract("height", r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double").alias("h"))
    j = matched.join(bounds, "preset", "left").join(h, "plant_id", "left")
    free = F.col("low").isNull() & F.col("high").isNull()
    return j.filter(free | (F.col("h") >= F.coalesce("low", "h")) & (F.col("h") <= F.coalesce("high", "h"))).select("preset", "plant_id").distinct()


def apply_presets(values: DataFrame, presets: DataFrame) -> DataFrame:
    """(preset, plant_id) satisfying every field of a preset by any of its values. ``presets``: preset, attribute_id, value."""
    presets = presets.distinct()
    need = presets.groupBy("preset").agg(F.countDistinct("attribute_id").alias("need"))
    have = values.join(presets, ["attribute_id", "value"]).groupBy("preset", "plant_id").agg(F.countDistinct("attribute_id").alias("have"))
    return have.join(need, "preset").filter("have = need").select("preset", "plant_id")


def dedup_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """First row of each key; rows whose key is null or blank all stay."""
    keyed = df.withColumn("__k__", F.nullif(F.trim(key), F.lit("")))
    first = keyed.withColumn("__r__", F.row_number().over(Window.partitionBy("__k__").orderBy(*order))).filter("__k__ is not null and __r__ = 1").drop("__r__")
    return first.unionByName(keyed.filter("__k__ is null")).drop("__k__")


def gap_entities(entities: DataFrame, values: DataFrame, attribute) -> DataFrame:
    have = values.filter(F.col("attribute_id") == attribute).select("plant_id")
    return entities.join(have, entities["id"] == have["plant_id"], "left_anti")


def gap_matrix(entities: DataFrame, attributes: DataFrame, values: DataFrame) -> DataFrame:
    """(plant_id, attribute_id) without a row in the store. The result is that product less what is there.

    The attribute list is a dimension table: its ids travel as one array (checked to be few), so nothing is joined without a key.
    """
    ids = attributes.select(F.col("id").alias("attribute_id")).distinct().agg(F.collect_list("attribute_id").alias("all_ids"))
    have = values.select("plant_id", "attribute_id").distinct().groupBy("plant_id").agg(F.collect_list("attribute_id").alias("have"))
    lacking = F.array_except(few(ids).scalar(), F.coalesce("have", F.array().cast(ids.schema["all_ids"].dataType)))
    every = entities.select(F.col("id").alias("plant_id")).join(have, "plant_id", "left")
    return every.select("plant_id", F.explode(lacking).alias("attribute_id"))


# Fixed value: ids of calculated attributes start so.
CALCULATED = "b1000001-"
COVERAGE_ORDERS = {"coverage_asc": ("pct", False), "coverage_desc": ("pct", True), "name": ("name", False)}


def attribute_coverage(entities: DataFrame, attributes: DataFrame, values: DataFrame, category: str | None = None, sort: str = "coverage_asc", calculated: tuple = ()) -> DataFrame:
    """(attribute_id, name, category, n_entities, total, pct to one place, gap) of the attributes that are neither roots nor calculated.

    ``attributes``: id, name, parent_attribute_id. ``category`` keeps the children of one parent, case apart. Distinct pairs
    come first, so that few attributes do not make few tasks. An unknown ``sort`` reads as coverage_asc; ids break ties.
    """
    parents = attributes.select(F.col("id").alias("pid"), F.col("name").alias("pname"))
    use = attributes.filter(F.col("parent_attribute_id").isNotNull() & ~F.col("id").cast("string").startswith(CALCULATED))
    if calculated:
        use = use.filter(~F.col("id").isin(*calculated))
    use = use.join(parents, F.col("parent_attribute_id") == F.col("pid"), "left").select(F.col("id").alias("attribute_id"), "name", F.coalesce("pname", F.lit("Uncategorized")).alias("category"), "pname")
    if category is not None:
        use = use.filter(F.lower(F.coalesce("pname", F.lit(""))) == category.lower())
    have = values.select("attribute_id", "plant_id").distinct().groupBy("attribute_id").agg(F.count("*").alias("n"))
    out = use.join(have, "attribute_id", "left").withColumn("total", entities.agg(F.count("*").alias("total")).scalar())
    n = F.coalesce("n", F.lit(0))
    pct = F.floor(n / F.greatest("total", F.lit(1)) * 1000 + 0.5) / 10
    by, down = COVERAGE_ORDERS.get(sort, COVERAGE_ORDERS["coverage_asc"])
    shown = out.select("attribute_id", "name", "category", n.alias("n_entities"), "total", pct.alias("pct"), (F.col("total") - n).alias("gap"))
    return shown.orderBy(F.desc(by) if down else F.asc(by), "attribute_id")


def coverage_headline(coverage: DataFrame) -> DataFrame:
    return coverage.agg(F.round(F.avg("pct"), 1).alias("mean_pct"), F.count_if(F.col("pct") < 50).alias("under_half"), F.count("*").alias("n_attributes"))


def entity_completeness(entities: DataFrame, values: DataFrame, keys: list) -> DataFrame:
    """(plant_id, n_filled, pct) over the key attributes."""
    have = values.filter(F.col("attribute_id").isin(*keys) & F.col("value").isNotNull()).groupBy("plant_id").agg(F.countDistinct("attribute_id").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return entities.select(F.col("id").alias("plant_id")).join(have, "plant_id", "left").select("plant_id", n.alias("n_filled"), (F.floor(n / len(keys) * 1000 + 0.5) / 10).alias("pct"))


def entity_list(entities: DataFrame, values: DataFrame, keys: list) -> DataFrame:
    counts = values.filter("value is not null").groupBy("plant_id").agg(F.countDistinct("attribute_id").alias("n_attributes"), F.countDistinct(F.when(F.col("attribute_id").isin(*keys), F.col("attribute_id"))).alias("n_keys"))
    return entities.join(counts, entities["id"] == counts["plant_id"], "left").select(entities["*"], F.coalesce("n_attributes", F.lit(0)).alias("n_attributes"), F.coalesce("n_keys", F.lit(0)).alias("n_keys"))


# Sort keys of the entity browser.
BROWSER_ORDERS = {"scientific_name": ("genus", "species"), "common_name": ("common_name",), "attribute_count": ("attribute_count",), "completeness": ("completeness_pct",)}


def entity_browser(entities: DataFrame, values: DataFrame, keys: list, search: str | None = None, sort: str = "scientific_name", descending: bool = False, number: int = 1, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """A page of entities with the number of their values and the share of the key attributes that they have, and one row with the ``total``.

    ``search`` is looked for in the scientific and the common name, case apart. An unknown ``sort`` reads as scientific_name; nulls come last and ids
    break ties.
    """
    found = entities if search is None or not search.strip() else search_entities(entities, search.strip())
    counts = values.groupBy("plant_id").agg(F.count("*").alias("attribute_count"), F.countDistinct(F.when(F.col("attribute_id").isin(*keys), F.col("attribute_id"))).alias("filled"))
    out = found.join(counts, found["id"] == counts["plant_id"], "left")
    out = out.select(found["*"], F.coalesce("attribute_count", F.lit(0)).alias("attribute_count"), (F.floor(F.coalesce("filled", F.lit(0)) / len(keys) * 1000 + 0.5) / 10).alias("completeness_pct"))
    by = BROWSER_ORDERS.get(sort, BROWSER_ORDERS["scientific_name"])
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in by]
    return out.orderBy(*order, "id").offset((max(number, 1) - 1) * size).limit(size), found.agg(F.count("*").alias("total"))


def attribute_parents(attributes: DataFrame) -> DataFrame:
    p = attributes.select(F.col("id").alias("pid"), F.col("name").alias("parent_name"))
    return attributes.join(p, attributes["parent_attribute_id"] == p["pid"], "left").drop("pid")


#: Stands between the ids of a code; ids are taken not to hold it.
STEP = "\x1f"


def tree_codes(attributes: DataFrame) -> DataFrame:
    """(id, name, names, code): the names from the root down to each node, and their ids in one text, so that a node and all below it have
    the codes of one range (``below``).

    Pointer doubling: each round joins every node's furthest known ancestor with that one's own way, so that a tree of depth d takes
    log2(d) + 1 rounds, each written and read again. A way that reaches no root after as many steps as there are nodes is a cycle, which
    raises. A node whose parent is unknown counts as a root.
    """
    ids = attributes.select(F.col("id").alias("up")).distinct().withColumn("known", F.lit(True))
    now = attributes.select("id", "name", F.array("name").alias("names"), F.concat(F.col("id").cast("string"), F.lit(STEP)).alias("code"), F.col("parent_attribute_id").alias("up"))
    now = kept(now.join(ids, "up", "left").withColumn("up", F.when(F.col("known"), F.col("up"))).drop("known"))
    steps, nodes = 1, None
    while not now.filter("up is not null").isEmpty():
        nodes = attributes.count() if nodes is None else nodes
        if steps > 2 * nodes:
            raise ValueError("the attributes' parents form a cycle")
        above = now.select(F.col("id").alias("up"), F.col("names").alias("n2"), F.col("code").alias("c2"), F.col("up").alias("up2"))
        joined = now.join(above, "up", "left")
        names = F.when(F.col("n2").isNotNull(), F.concat("n2", "names")).otherwise(F.col("names"))
        now = kept(joined.select("id", "name", names.alias("names"), F.concat(F.coalesce("c2", F.lit("")), "code").alias("code"), F.col("up2").alias("up")))
        steps *= 2
    return now.select("id", "name", "names", "code")


def below(coded: DataFrame, code: str) -> DataFrame:
    """A node and all below it: a range of codes, which a table sorted by code reads a stretch of."""
    return coded.filter((F.col("code") >= code) & (F.col("code") < code + "\U0010ffff"))


def attribute_paths(attributes: DataFrame) -> DataFrame:
    """(id, name, root_name, path, level) of every node."""
    return tree_codes(attributes).select("id", "name", F.get("names", F.lit(0)).alias("root_name"), F.array_join("names", " > ").alias("path"), F.size("names").alias("level"))


def subtree(attributes: DataFrame, root: str) -> DataFrame:
    """(id, name, path, level) of the nodes named ``root``, wherever they stand, and of all below them."""
    hit = tree_codes(attributes).filter(F.array_contains("names", root))
    return hit.select("id", "name", F.array_join("names", " > ").alias("path"), F.size("names").alias("level"))


def entity_values(values: DataFrame, attributes: DataFrame, sources: DataFrame) -> DataFrame:
    a = attribute_paths(attributes).select(F.col("id").alias("attribute_id"), F.col("name").alias("attribute_name"), "root_name", "path")
    s = sources.select(F.col("id").alias("sid"), F.col("name").alias("source_name"))
    out = values.drop("attribute_name").join(a, "attribute_id")
    return out.join(s, out["source_id"] == s["sid"], "left").drop("sid").withColumn("is_calculated", F.col("source_id").isNull())


def source_attribution(values: DataFrame, sources: DataFrame) -> DataFrame:
    s = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    return values.filter("source_id is not null").select("plant_id", "attribute_id", "source_id").distinct().join(s, "source_id")


def resolve_values(values: DataFrame, attributes: DataFrame) -> DataFrame:
    """``display``: the allowed value's name for a code; other values pass through."""
    codes = attributes.select(F.col("id").alias("attribute_id"), F.explode(F.from_json("values_allowed", "array<struct<id:string,displayName:string>>")).alias("a")).select("attribute_id", F.col("a.id").alias("value"), F.col("a.displayName").alias("shown"))
    return values.join(codes, ["attribute_id", "value"], "left").withColumn("display", F.coalesce("shown", "value")).drop("shown")


def pivot_entities(values: DataFrame, attribute_ids: list) -> DataFrame:
    """One array column for each listed attribute, holding its sorted distinct values."""
    cols = [F.array_sort(F.collect_set(F.when(F.col("attribute_id") == a, F.col("value")))).alias(f"a{a}") for a in attribute_ids]
    return values.filter(F.col("attribute_id").isin(*attribute_ids)).groupBy("plant_id").agg(*cols)


# Calculated flags and the attribute whose presence each of them tells.
HAS_FLAGS = {
    "availability": "94a1c46e-8d0c-4a8b-b951-09ee6b04a43e", "climate_rating": "2cd5ffd7-10f1-431d-945e-064bcfd2c195", "deer_resistance": "ff4c4d0e-35d5-4804-aea3-2a6334ef8cb5",
    "drought_tolerant": "53aedc01-99c6-4115-903b-7db799966427", "easy_to_grow": "009ab722-f032-431f-ae53-3b82e5f03ece", "edible_plant": "cba229ad-e004-4ece-ac5b-f2bb3ac0c6a5",
    "erosion_control": "f3e261e1-2dc8-4abb-8665-3b4cf6521fc6", "flammability_rating": "d996587c-383b-4dc6-a23c-239b7de7e47b", "landscape_use": "055d0d05-6927-4ed4-b16c-894fe54d77e0",
    "native_status": "716f3d8f-195f-4d16-824b-6dd1e88767a6", "soils_rating": "1b3ac1d2-3de1-479d-a472-1db3572971e7", "water_amount": "d9174148-6563-4f92-9673-01feb6a529ce",
}
WILDLIFE, INVASIVE = "e8686d2e-fe16-440e-bc70-af4a0328cd05", "bacadba3-a4f8-4550-9906-6b5535a619b6"


def calculated_attributes(values: DataFrame, wildlife_points: dict[str, int], invasive_points: dict[str, int], flags: dict = HAS_FLAGS, wildlife=WILDLIFE, invasive=INVASIVE) -> DataFrame:
    """The declared matrix: a flag for each of the twelve attributes that an entity has a value of, the wildlife sum (0 to 6), the
    invasive component (-3 to 0) and their total. The points of values are inputs."""
    return value_matrix(values, {n: (a, None) for n, a in flags.items()}, {"wildlife": (wildlife, wildlife_points, 0, 6), "invasive": (invasive, invasive_points, -3, 0)})


def value_matrix(values: DataFrame, flags: dict[str, tuple], components: dict[str, tuple]) -> DataFrame:
    """0/1 ``has_<flag>`` by (attribute, values; None for any), component sums by (attribute, {value: points}, low, high), and their total."""
    hit = lambda a, v: (F.col("attribute_id") == a) & (F.col("value").isNotNull() if v is None else F.col("value").isin(*v))
    has = [F.max(F.when(hit(a, v), 1).otherwise(0)).alias(f"has_{n}") for n, (a, v) in flags.items()]
    sums = []
    for n, (a, points, low, high) in components.items():
        p = F.lit(0)
        for value, x in points.items():
            p = F.when((F.col("attribute_id") == a) & (F.col("value") == value), x).otherwise(p)
        sums.append(F.greatest(F.lit(low), F.least(F.lit(high), F.sum(p))).alias(n))
    total = sum((F.col(n) for n in components), F.lit(0))
    return values.groupBy("plant_id").agg(*has, *sums).withColumn("total", total)


def cross_reference(a: DataFrame, b: DataFrame, key: str = "name") -> DataFrame:
    k = lambda df: df.select(F.lower(F.trim(key)).alias(key))
    return k(a).intersect(k(b))


def listing_status(names: DataFrame, listings: DataFrame) -> DataFrame:
    """(name, listed_in): lists (list, text) an entry of which holds the name anywhere, case apart, also within a word; a blank name is in none."""
    n = names.select("name", F.lower(F.trim("name")).alias("k")).distinct()
    entries = listings.select("list", F.lower("text").alias("text")).distinct()
    hit = containing(entries, n.select(F.col("k").alias("word"))).select(F.col("word").alias("k"), "list").distinct()
    lists = n.join(hit, "k").groupBy("name").agg(F.array_sort(F.collect_set("list")).alias("listed_in"))
    return names.select("name").distinct().join(lists, "name", "left").withColumn("listed_in", F.coalesce("listed_in", F.array().cast("array<string>")))


def build_backbone(names: DataFrame, distribution: DataFrame) -> DataFrame:
    """Accepted names with native and introduced regions, each sorted, distinct and comma-joined; the long side is aggregated first."""
    region = lambda flag: F.array_join(F.array_sort(F.collect_set(F.when(F.col("introduced") == flag, F.col("area")))), ", ")
    d = distribution.groupBy("plant_name_id").agg(region("0").alias("native_to"), region("1").alias("introduced_to"))
    return accepted_species(names).join(d, "plant_name_id", "left")


def merge_details(base: DataFrame, details: DataFrame, key: str) -> DataFrame:
    shared = [c for c in details.columns if c != key]
    d = details.select(key, *[F.col(c).alias(f"__{c}") for c in shared])
    out = base.join(d, key, "left")
    for c in shared:
        out = out.withColumn(c, F.coalesce(f"__{c}", c) if c in base.columns else F.col(f"__{c}")).drop(f"__{c}")
    return out


def taxonomy_profile(names: DataFrame, backbones: list[tuple[str, DataFrame]], columns: list[str]) -> DataFrame:
    """Each column from the first backbone (name, columns…) that has it, and the list of backbones that know the name."""
    out = names.select("name").distinct().withColumn("k", F.lower("name"))
    for label, b in backbones:
        have = [c for c in columns if c in b.columns]
        out = out.join(b.groupBy(F.lower("name").alias("k")).agg(F.lit(True).alias(f"in_{label}"), *[F.min(c).alias(f"{label}_{c}") for c in have]), "k", "left")
    merged = [F.coalesce(*[F.col(f"{label}_{c}") for label, b in backbones if c in b.columns], F.lit(None)).alias(c) for c in columns]
    return out.select("name", *merged, F.array_compact(F.array(*[F.when(F.col(f"in_{label}"), F.lit(label)) for label, _ in backbones])).alias("sources"))


# Columns that tell no trait of a plant.
STRUCTURAL_COLUMNS = ("id", "ID", "rowid", "taxon_id", "taxon_ID", "source_plant_id", "source_plant_ID", "source_leaf_id", "source_leaf_ID", "source_distrib_id", "source_distrib_ID", "source_ID", "source_id", "site_ID", "site_id", "symbol", "is_synonym")
STRATEGIES = ("exact", "genus", "prefix", "synonymy")


def lookup_rows(names: DataFrame, rows: DataFrame, strategies: DataFrame, synonymy: DataFrame | None = None) -> DataFrame:
    """(asked, dataset, source_row, matched_name, confidence): the first row (dataset, source_row, name) of each dataset for each name.

    ``strategies`` (dataset, strategy) tells how a dataset is asked, a dataset that it does not name exactly: by the whole name, case apart
    (exact, 1.0); by the name's first word (genus, 0.8); rows whose name, an author behind it, begins with the name (prefix, 1.0); exactly
    and, where that finds nothing, by the taxon_name that ``synonymy`` (original_name, taxon_name) gives the name (synonymy, 0.9).
    """
    n = names.select(F.trim("name").alias("asked")).filter("asked <> ''").distinct().withColumn("k", F.lower("asked"))
    r = rows.select("dataset", "source_row", F.col("name").alias("matched_name"), F.lower("name").alias("k")).join(strategies, "dataset", "left").withColumn("strategy", F.coalesce("strategy", F.lit("exact")))
    first = lambda hit, sure: hit.groupBy("asked", "dataset").agg(F.min(F.struct("source_row", "matched_name")).alias("f")).select("asked", "dataset", "f.source_row", "f.matched_name", F.lit(sure).alias("confidence"))
    whole = r.filter(F.col("strategy").isin("exact", "synonymy"))
    exact = first(n.join(whole, "k"), 1.0)
    genus = first(n.select("asked", F.get(F.split("k", r"\s+"), F.lit(0)).alias("k")).join(r.filter("strategy = 'genus'"), "k"), 0.8)
    # A row is asked for at those of its lengths that some name has, and so by an equal key.
    lengths = n.agg(F.array_sort(F.collect_set(F.length("asked"))).alias("lengths"))
    cut = r.filter("strategy = 'prefix'").withColumn("lengths", lengths.scalar()).withColumn("at", F.explode("lengths")).filter(F.col("at") <= F.length("k"))
    prefix = first(n.join(cut.select("dataset", "source_row", "matched_name", F.expr("left(k, at)").alias("k")), "k"), 1.0)
    out = exact.unionByName(genus).unionByName(prefix)
    if synonymy is None:
        return out
    # The first of a name's entries in the synonymy counts, in the order of the accepted names.
    known_as = synonymy.groupBy(F.lower(F.trim("original_name")).alias("k")).agg(F.lower(F.min("taxon_name")).alias("to"))
    asked = n.join(known_as, "k").select("asked", F.col("to").alias("k")).join(whole.filter("strategy = 'synonymy'"), "k")
    return out.unionByName(first(asked.join(exact.select("asked", "dataset"), ["asked", "dataset"], "left_anti"), 0.9))


def lookup_sources(names: DataFrame, long: DataFrame, strategies: DataFrame, synonymy: DataFrame | None = None, attributes: DataFrame | None = None) -> DataFrame:
    """Every non-blank cell (dataset, source_row, name, column, value) of the rows that ``lookup_rows`` finds for a name:
    (asked, dataset, matched_name, column, value, confidence), and the attribute of ``attributes`` (column, attribute_id, attribute_name), if there is one.

    Columns that tell no trait are left out. Column names are compared case apart.
    """
    rows = long.select("dataset", "source_row", "name").distinct()
    found = lookup_rows(names, rows, strategies, synonymy)
    cells = long.filter((F.trim("value") != "") & ~F.col("column").isin(*STRUCTURAL_COLUMNS)).select("dataset", "source_row", "column", F.trim("value").alias("value"))
    out = found.join(cells, ["dataset", "source_row"]).select("asked", "dataset", "matched_name", "column", "value", "confidence")
    if attributes is None:
        return out
    a = attributes.groupBy(F.lower("column").alias("__c__")).agg(F.min(F.struct("attribute_id", "attribute_name")).alias("a"))
    return out.join(a, F.lower("column") == F.col("__c__"), "left").select(*out.columns, "a.attribute_id", "a.attribute_name")


def swap_pairs(df: DataFrame, bad: str = "bad", good: str = "good", sep: str = ";") -> DataFrame:
    """Every bad item with every good one of the same cell pair."""
    return df.withColumn(bad, F.explode(F.transform(F.split(bad, sep), lambda x: F.trim(x)))).withColumn(good, F.explode(F.transform(F.split(good, sep), lambda x: F.trim(x))))
