"""Matching names to entities: exact, synonym, cultivar, genus and fuzzy tiers.

Matching runs once for each distinct name, tier by tier: a tier sees the names that the ones before left open. The fuzzy tier
compares species within a known genus; names of unknown genera are compared whole, by pieces of the name and then by length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import binomial_key, parse_full_name, parse_name, similarity
from ..sources.scratch import kept


def _index(entities: DataFrame) -> DataFrame:
    """(g, s, plant_id, match_count): first entity by genus, species and id for each lower-cased name."""
    return entities.filter("genus is not null").groupBy(F.lower("genus").alias("g"), F.lower(F.coalesce("species", F.lit(""))).alias("s")).agg(F.min("id").alias("plant_id"), F.count("*").alias("match_count"), F.min_by("genus", "id").alias("e_genus"), F.min_by("species", "id").alias("e_species"))


def parsed(names: DataFrame) -> DataFrame:
    """Distinct names (name) with genus and species, as written (genus, species) and in lower case (g, s)."""
    p = names.filter("name is not null").select(F.trim("name").alias("name")).distinct().withColumn("p", parse_name("name"))
    return p.select("name", F.lower("p.genus").alias("g"), F.lower("p.species").alias("s"), "p.cultivar", "p.is_genus_only", "p.genus", "p.species")


def match_exact(names: DataFrame, entities: DataFrame) -> DataFrame:
    """Every distinct name with plant_id and match_count where genus and species agree."""
    return parsed(names).drop("genus", "species").join(_index(entities).drop("e_genus", "e_species"), ["g", "s"], "left")


def _genera(entities: DataFrame) -> DataFrame:
    return entities.filter("genus is not null").groupBy(F.lower("genus").alias("g")).agg(F.count("*").alias("n_in_genus"), F.min("id").alias("only"))


def match_genus(names: DataFrame, entities: DataFrame) -> DataFrame:
    """Names of a known genus: how many entities it has, and the entity if it is the only one."""
    return parsed(names).join(_genera(entities), "g").select("name", "n_in_genus", F.when(F.col("n_in_genus") == 1, F.col("only")).alias("plant_id"))


def _edits(longest: Column, threshold: float) -> Column:
    """The edits that two texts may differ in at that similarity, the longer one being so long."""
    return F.floor((1 - threshold) * longest + 1e-9).cast("int")


def _piece(length: Column, n: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of piece i of n of a text, as even as can be, the longer ones last."""
    size, short = F.floor(length / n).cast("int"), n - length % n
    return i * size + F.greatest(i - short, F.lit(0)), size + F.when(i >= short, 1).otherwise(0)


def near_names(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(name, plant_id, g, s, sim) of all pairs of ``names`` (name, full) and ``known`` (plant_id, g, s, full) at least that similar.

    Of two texts within d edits, cut one into d + 1 pieces: some piece i stands unchanged in the other with at most i edits before it and
    d - i after it, which bounds how far it can have moved. Pieces, with the length of their text, are the join key; no pair that counts
    is lost and none is formed without one.
    """
    d = lambda a, b: _edits(F.greatest(a, b), threshold)
    lengths = lambda n: F.sequence(F.ceil(n * threshold - 1e-9).cast("int"), F.floor(n / threshold + 1e-9).cast("int"))
    own = known.filter("full <> ''").withColumn("n", F.length("full")).withColumn("other", F.explode(lengths(F.col("n"))))
    own = own.withColumn("d", d(F.col("n"), F.col("other"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    start, size = _piece(F.col("n"), F.col("d") + 1, F.col("i"))
    own = own.filter(size > 0).select("plant_id", "g", "s", F.col("full").alias("known"), "n", "other", "i", F.substring("full", start + 1, size).alias("piece"))
    asked = names.filter("full <> ''").withColumn("other", F.length("full")).withColumn("n", F.explode(lengths(F.col("other"))))
    asked = asked.withColumn("d", d(F.col("n"), F.col("other"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    later, after = F.col("other") - F.col("n"), F.col("d") - F.col("i")
    low = F.greatest(F.lit(0), start - F.col("i"), start + later - after)
    high = F.least(F.col("other") - size, start + F.col("i"), start + later + after)
    asked = asked.filter((size > 0) & (low <= high)).select("name", "full", "n", "other", "i", F.explode(F.array_distinct(F.transform(F.sequence(low, high), lambda at: F.substring("full", at + 1, size)))).alias("piece"))
    pairs = asked.join(own, ["n", "other", "i", "piece"]).select("name", "full", "plant_id", "g", "s", "known").distinct()
    return pairs.withColumn("sim", similarity("full", "known")).filter(F.col("sim") >= threshold).drop("full", "known")


#: Known names in one row of ``_blocks``: the bound of what is compared at once.
BLOCK = 512


def _blocks(known: DataFrame, key: Column) -> DataFrame:
    """(key, members): the known names (plant_id, g, s, text) of each key in arrays of about ``BLOCK``."""
    k = known.withColumn("key", key)
    sizes = k.groupBy("key").agg(F.count("*").alias("n"))
    cut = k.join(sizes, "key").withColumn("b", F.pmod(F.xxhash64("g", "s"), F.ceil(F.col("n") / BLOCK)))
    return cut.groupBy("key", "b").agg(F.collect_list(F.struct("plant_id", "g", "s", "text")).alias("members")).drop("b")


def _nearest(asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(name, plant_id, g, s, sim): of ``asked`` (name, key, text) the first ``k`` of each block of its keys.

    A name meets blocks, not their members: the comparison is within the row, so that a pair is no row unless it is among the first.
    """
    scored = lambda m: F.struct((-similarity(F.col("text"), m["text"])).alias("o"), m["plant_id"].alias("plant_id"), m["g"].alias("g"), m["s"].alias("s"))
    hit = asked.join(blocks, "key").select("name", F.explode(F.slice(F.array_sort(F.transform("members", scored)), 1, k)).alias("m"))
    return hit.select("name", "m.plant_id", "m.g", "m.s", (-F.col("m.o")).alias("sim"))


def _first(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar of each name, ranked; a rank with a limit, so that each task keeps its first k before the shuffle."""
    return pairs.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("sim"), "plant_id"))).filter(F.col("r") <= k)


def nearest_names(names: DataFrame, known: DataFrame, k: int = 3, radii: tuple[float, ...] = (0.85, 0.7)) -> DataFrame:
    """(name, plant_id, g, s, sim, r): the ``k`` known names (plant_id, g, s, full) most similar to each of ``names`` (name, full),
    however far they are; equal ones go by id.

    The radius grows until k are proven nearest. At each of ``radii`` the piece filter finds all pairs at least that similar, and names with
    k of them are done. The rest are compared by length: two texts are at most as similar as the shorter length over the
    longer one. Lengths within the last radius give a k-th best, and only lengths that could beat it are looked at after that.
    Both tables are read in every round, so they had better be stored ones.
    """
    known = known.filter("full <> ''").select("plant_id", "g", "s", "full")
    left, found = names.filter("full <> ''").select("name", "full").distinct(), None
    for t in radii:
        pairs = kept(near_names(left, known, t))
        done = pairs.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select("name")
        part = pairs.join(done, "name", "left_semi")
        found = part if found is None else found.unionByName(part)
        left = left.join(done, "name", "left_anti")
    blocks = kept(_blocks(known.withColumnRenamed("full", "text"), F.length("text")))
    last = float(radii[-1])
    reach = lambda ratio: (F.ceil(F.length("full") * ratio - 1e-9).cast("int"), F.floor(F.length("full") / ratio + 1e-9).cast("int"))
    low, high = reach(F.lit(last))
    asked = left.select("name", "full", F.col("full").alias("text"), F.explode(F.sequence(low, high)).alias("key"))
    close = kept(_first(_nearest(asked.drop("full"), blocks, k), k).drop("r"))
    worst = close.groupBy("name").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(0.0).alias("worst"))
    open_ = left.join(worst, "name", "left").withColumn("worst", F.coalesce("worst", F.lit(0.0))).filter(F.col("worst") < last)
    # A length that no known name has costs a key without a block; beyond the longest known one there are none.
    longest = known.agg(F.max(F.length("full")).alias("m"))
    lo, hi = reach(F.greatest("worst", F.lit(1e-6)))
    open_ = open_.withColumn("m", longest.scalar()).withColumns({"lo": F.greatest(lo, F.lit(1)), "hi": F.least(hi, F.coalesce("m", F.lit(0)))}).filter("lo <= hi")
    more = open_.select("name", "full", F.col("full").alias("text"), F.explode(F.sequence("lo", "hi")).alias("key")).filter((F.col("key") < low) | (F.col("key") > high))
    far = _nearest(more.drop("full"), blocks, k)
    return _first(found.unionByName(close).unionByName(far), k)


def _candidates(open_names: DataFrame, entities: DataFrame, k: int) -> DataFrame:
    """(name, c): up to ``k`` nearest entities of parsed names (name, g, s), best first, each with the way it was compared.

    Names of a known genus and with a species stay within that genus, by the species; all others are compared whole.
    """
    e = kept(_index(entities).drop("match_count"))
    asked = open_names.join(e.select("g").distinct().withColumn("in_genus", F.lit(True)), "g", "left").withColumn("in_genus", F.col("in_genus").isNotNull() & F.col("s").isNotNull())
    asked = kept(asked.select("name", "g", "s", "in_genus"))
    within = _first(_nearest(asked.filter("in_genus").select("name", F.col("g").alias("key"), F.col("s").alias("text")), _blocks(e.select("plant_id", "g", "s", F.col("s").alias("text")), F.col("g")), k), k)
    whole = F.trim(F.concat_ws(" ", "g", "s"))
    far = nearest_names(asked.filter("not in_genus").select("name", whole.alias("full")), e.withColumn("full", whole), k)
    both = within.withColumn("in_genus", F.lit(True)).unionByName(far.withColumn("in_genus", F.lit(False)))
    shown = both.drop("g", "s").join(e.select("plant_id", F.col("e_genus").alias("genus"), F.col("e_species").alias("species")), "plant_id")
    return shown.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("r", "plant_id", "genus", "species", "sim", "in_genus"))).alias("c"))


ALTERNATIVES = 3


def _shown(c: Column) -> Column:
    """The first three candidates, the best included."""
    return F.transform(F.slice(c, 1, ALTERNATIVES), lambda x: F.struct(x["plant_id"].alias("plant_id"), x["genus"].alias("genus"), x["species"].alias("species"), x["sim"].alias("similarity")))


def match_fuzzy(names: DataFrame, entities: DataFrame, threshold: float = 0.85, k: int = 5) -> DataFrame:
    """(name, plant_id, sim, confidence, tie, alternatives): the nearest entity by species within the name's genus or, for unknown genera and
    names without a species, by the whole name, where it is similar enough.

    ``tie`` marks a second candidate within 0.05, whether or not that one is similar enough. ``alternatives`` are the first three candidates.
    Equal similarities go by entity id.
    """
    hit = _candidates(kept(parsed(names)), entities, k).filter(F.col("c")[0]["sim"] >= threshold)
    best, second = F.col("c")[0], F.get("c", F.lit(1))["sim"]
    return hit.select("name", best["plant_id"].alias("plant_id"), best["sim"].alias("sim"), (0.9 * best["sim"]).alias("confidence"), F.coalesce(second >= best["sim"] - 0.05, F.lit(False)).alias("tie"), _shown(F.col("c")).alias("alternatives"))


def resolve_synonyms(names: DataFrame, backbone: DataFrame) -> DataFrame:
    """(name, accepted, followed): backbone row whose full name starts with the name, accepted rows first; synonyms lead to the
    accepted row of their symbol. ``backbone``: name_full, symbol, is_synonym (0/1)."""
    b = backbone.select(F.lower("name_full").alias("full"), F.col("name_full").alias("shown"), "symbol", F.col("is_synonym").cast("int").alias("syn")).withColumn("bg", F.get(F.split("full", " "), F.lit(0)))
    n = names.select(F.trim("name").alias("name")).distinct().withColumn("key", F.lower("name")).withColumn("g", F.get(F.split("key", " "), F.lit(0)))
    hit = n.join(b, (F.col("g") == F.col("bg")) & F.col("full").startswith(F.col("key")))
    first = hit.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy("syn", "full", "symbol"))).filter("r = 1")
    accepted = b.filter("syn = 0").groupBy("symbol").agg(F.min("shown").alias("to"))
    return first.join(accepted, "symbol", "left").select("name", F.when(F.col("syn") == 0, F.col("shown")).otherwise(F.col("to")).alias("accepted"), (F.col("syn") == 1).alias("followed")).filter("accepted is not null")


def resolve_name(names: DataFrame, backbones: list[tuple[str, DataFrame]]) -> DataFrame:
    """Accepted name by backbone priority: (name, accepted, synonym_of, source, confidence); 1.0 accepted, 0.95 synonym, 0 none.

    The first backbone resolves synonyms; later ones (with name_full) only confirm accepted names.
    """
    n = names.select(F.trim("name").alias("name")).distinct()
    label, first = backbones[0]
    out = n.join(resolve_synonyms(names, first), "name", "left").withColumn("source", F.when(F.col("accepted").isNotNull(), label))
    for label, b in backbones[1:]:
        known = b.groupBy(F.lower("name_full").alias("k")).agg(F.min("name_full").alias("shown"))
        out = out.join(known, F.lower("name") == F.col("k"), "left").withColumns({"source": F.coalesce("source", F.when(F.col("shown").isNotNull(), label)), "accepted": F.coalesce("accepted", "shown")}).drop("k", "shown")
    followed = F.coalesce("followed", F.lit(False))
    return out.select("name", "accepted", F.when(followed, F.col("name")).alias("synonym_of"), "source", F.when(F.col("accepted").isNull(), 0.0).when(followed, 0.95).otherwise(1.0).alias("confidence"))


def _synonyms(open_names: DataFrame, entities: DataFrame, backbone: DataFrame) -> DataFrame:
    """(name, plant_id, accepted) for parsed names (name, g, s) with a species, looked up as genus and species alone."""
    asked = open_names.filter("s is not null").select("name", F.concat_ws(" ", "g", "s").alias("key"))
    followed = resolve_synonyms(asked.select(F.col("key").alias("name")), backbone).filter("followed").select(F.col("name").alias("key"), parse_full_name("accepted").alias("f"))
    to = followed.select("key", F.concat_ws(" ", "f.genus", "f.species").alias("accepted"), F.lower("f.genus").alias("g"), F.lower("f.species").alias("s")).join(_index(entities), ["g", "s"])
    return asked.join(to.select("key", "plant_id", "accepted"), "key").select("name", "plant_id", "accepted")


def match_synonym(open_names: DataFrame, entities: DataFrame, backbone: DataFrame) -> DataFrame:
    """(name, plant_id) of names whose genus and species a backbone leads to another accepted name, which is an entity's.

    A cultivar or a hybrid mark does not stand in the way; names without a species are not looked up.
    """
    return _synonyms(kept(parsed(open_names)), entities, backbone).select("name", "plant_id")


def match_cultivar(open_names: DataFrame, entities: DataFrame) -> DataFrame:
    """(name, plant_id) of names that match once the cultivar is dropped. The parser drops it before the exact tier, so after that none is left."""
    return match_exact(open_names.filter(F.col("name").contains("'")), entities).filter("plant_id is not null and cultivar is not null").select("name", "plant_id")


def _percent(sim: Column) -> Column:
    return F.floor(sim * 100 + 0.5).cast("string")


def match_entities(names: DataFrame, entities: DataFrame, backbone: DataFrame | None = None, threshold: float = 0.85, backbone_name: str = "USDA_PLANTS") -> DataFrame:
    """One row for each distinct name: (name, match_type, plant_id, confidence, cultivar, tie, alternatives, notes).

    Tiers: EXACT 1.0, SYNONYM 0.95, CULTIVAR 0.9, GENUS_ONLY 0.5 (with the entity if the genus has one), FUZZY 0.9 x similarity,
    NONE 0. The parser drops the cultivar, so the CULTIVAR tier finds what EXACT found and stays empty. FUZZY and NONE rows carry the three
    nearest entities, however far. ``notes`` says how a name was matched, in the words of the reviewers' reports.
    """
    # Parsed once: the expressions are long, and would be repeated in every step that reads them.
    p = kept(parsed(names)).join(_index(entities).select("g", "s", "plant_id"), ["g", "s"], "left").join(_genera(entities), "g", "left")
    found, synonym = F.col("plant_id").isNotNull(), F.lit(False)
    if backbone is not None:
        p = p.join(_synonyms(p.filter("plant_id is null").select("name", "g", "s"), entities, backbone).withColumnRenamed("plant_id", "p2"), "name", "left")
        synonym = F.col("p2").isNotNull()
    else:
        p = p.withColumns({"p2": F.lit(None).cast("long"), "accepted": F.lit(None).cast("string")})
    # The lookup without the cultivar is that of the exact tier.
    kind = F.when(found, "EXACT").when(synonym, "SYNONYM").when(found & F.col("cultivar").isNotNull(), "CULTIVAR").when(F.col("s").isNull() & F.col("n_in_genus").isNotNull(), "GENUS_ONLY")
    p = kept(p.withColumn("kind", kind))
    c = _candidates(p.filter("kind is null").select("name", "g", "s"), entities, 5)
    out = p.join(c, "name", "left")
    best = F.get("c", F.lit(0))
    near = F.col("kind").isNull() & F.coalesce(best["sim"] >= threshold, F.lit(False))
    out = out.withColumn("match_type", F.coalesce("kind", F.when(near, "FUZZY"), F.lit("NONE")))
    what = F.col("match_type")
    pick = F.when(what == "SYNONYM", F.col("p2")).when(what == "GENUS_ONLY", F.when(F.col("n_in_genus") == 1, F.col("only"))).when(what == "FUZZY", best["plant_id"]).when(what != "NONE", F.col("plant_id"))
    sure = F.when(what == "EXACT", 1.0).when(what == "SYNONYM", 0.95).when(what == "CULTIVAR", 0.9).when(what == "GENUS_ONLY", 0.5).when(what == "FUZZY", 0.9 * best["sim"]).otherwise(0.0)
    likeness = F.when(best["sim"] == 1, "exact").otherwise(F.concat(_percent(best["sim"]), F.lit("% similar")))
    name = F.concat_ws(" ", "genus", "species")
    notes = (
        F.when(what == "EXACT", F.concat(F.lit("Exact match on "), name))
        .when(what == "SYNONYM", F.concat(F.lit(f"Synonym resolved via {backbone_name}: "), name, F.lit(" → "), F.col("accepted")))
        .when(what == "CULTIVAR", F.concat(F.lit("Cultivar stripped: '"), F.col("cultivar"), F.lit("' removed, matched on "), name))
        .when((what == "GENUS_ONLY") & F.col("cultivar").isNotNull(), F.concat(F.lit("Cultivar '"), F.col("cultivar"), F.lit("' with genus-only match ("), F.col("n_in_genus"), F.lit(" plants in genus)")))
        .when(what == "GENUS_ONLY", F.concat(F.lit("Genus-only match: "), F.col("n_in_genus"), F.lit(" plants in genus "), F.col("genus")))
        .when(what == "FUZZY", F.concat(F.lit("Fuzzy match: "), F.when(best["in_genus"], F.lit("genus exact, species ")).otherwise("full name "), likeness))
        .otherwise(F.concat(F.lit("No match found for "), F.col("name"), F.coalesce(F.concat(F.lit(" (best fuzzy: "), F.concat_ws(" ", best["genus"], best["species"]), F.lit(" at "), _percent(best["sim"]), F.lit("%)")), F.lit(""))))
    )
    tie = F.coalesce((what == "FUZZY") & (F.get("c", F.lit(1))["sim"] >= best["sim"] - 0.05), F.lit(False))
    empty = F.array().cast("array<struct<plant_id:bigint,genus:string,species:string,similarity:double>>")
    shown = F.when(what.isin("FUZZY", "NONE"), F.coalesce(_shown(F.col("c")), empty)).otherwise(empty)
    return out.select("name", "match_type", pick.alias("plant_id"), sure.alias("confidence"), "cultivar", tie.alias("tie"), shown.alias("alternatives"), notes.alias("notes"))


def match_rows(rows: DataFrame, matches: DataFrame, name_col: str = "name") -> DataFrame:
    """Every input row with the match of its name; rows without a name are NONE. Names are matched once and joined back."""
    m = matches.withColumnRenamed("name", "__k__")
    out = rows.join(m, F.trim(name_col) == F.col("__k__"), "left").drop("__k__")
    return out.withColumns({"match_type": F.coalesce("match_type", F.lit("NONE")), "confidence": F.coalesce("confidence", F.lit(0.0)), "tie": F.coalesce("tie", F.lit(False)), "notes": F.coalesce("notes", F.lit("No match found"))})


def match_summary(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_type").agg(F.count("*").alias("n"))


def expand_genus(matches: DataFrame, entities: DataFrame) -> DataFrame:
    """Genus matches without an entity get a row for each entity of the genus; others stay."""
    genus = F.lower(parse_name("name")["genus"])
    open_ = matches.filter("match_type = 'GENUS_ONLY' and plant_id is null").withColumn("g", genus)
    e = entities.select(F.lower("genus").alias("g"), F.col("id").alias("member"))
    grown = open_.join(e, "g", "left").withColumn("plant_id", F.col("member")).drop("g", "member")
    return matches.filter("not (match_type = 'GENUS_ONLY' and plant_id is null)").unionByName(grown)


def enrichment_candidates(gaps: DataFrame, source_values: DataFrame) -> DataFrame:
    """Gaps (plant_id, attribute_id, genus, species) with a value from a source (attribute_id, name, value, source, source_row);
    of repeated names in a source the last row counts."""
    s = source_values.groupBy("attribute_id", "source", F.lower(F.trim("name")).alias("k")).agg(F.max_by("value", "source_row").alias("value"))
    return gaps.withColumn("k", binomial_key("genus", "species")).join(s, ["attribute_id", "k"]).drop("k")


def enrichment_summary(gaps: DataFrame, candidates: DataFrame) -> DataFrame:
    """(attribute_id, n_gaps, n_names, sources): gaps, distinct names that some source can fill, and rows by source (sorted).

    ``gaps`` and ``candidates`` as taken and returned by ``enrichment_candidates``. Names are made distinct before they are
    counted, so that one large attribute is spread over tasks.
    """
    n = gaps.groupBy("attribute_id").agg(F.count("*").alias("n_gaps"))
    known = candidates.select("attribute_id", binomial_key("genus", "species").alias("k")).distinct().groupBy("attribute_id").agg(F.count("*").alias("n_names"))
    by = candidates.groupBy("attribute_id", "source").agg(F.count("*").alias("n")).groupBy("attribute_id").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"))
    out = n.join(known, "attribute_id", "left").join(by, "attribute_id", "left")
    return out.select("attribute_id", "n_gaps", F.coalesce("n_names", F.lit(0)).alias("n_names"), F.coalesce("sources", F.array().cast("array<struct<source:string,n:bigint>>")).alias("sources"))
