"""Benchmark decontamination by templates, with DataFrame functions alone.

A text becomes a template: numbers turn into ``xnumx``, capitalised words, wherever they stand, into ``xnamex`` (neighbouring ones into a
single one, so that names of any number of words are alike), units after a number into ``xunitx``; the rest is lower-cased,
marks fall away. Windows of ``window`` template words are hashed and joined to the benchmark's. A pair of text and item counts if at
least ``least`` (0.8) of the item's distinct windows occur in the text. Then its slots are compared: on the
alignment that most windows share, each value in a slot of the item must stand for one value in the text; the share of the item's
distinct slot values that do is the consistency, and pairs under ``consistent`` (0.8) are dropped. So a question asked again
with other numbers or names is caught, and a text that only shares its skeleton is not.

Texts are read a second time without case, where no word looks like a name: there the item's windows without its names stand for it (all of
them, if fewer than ``FREE`` hold no name), the words where the item has names are slots like its numbers, and at least ``least`` of its other
words have to stand where they belong. So lower-cased, upper-cased and partly lower-cased questions are caught, as they stand and
with other numbers and names of as many words.

One pass over the texts keeps the windows that any item has (their hashes are broadcast up to ``broadcast_windows`` of them, counted first;
beyond that the join shuffles). A pair that counts lacks few windows, so it has one of the item's rarest few: only those are joined to find
pairs, and windows that all items and texts share never meet each other.

Edge cases: null, empty and wordless texts and items match nothing; texts and items of fewer than ``window`` words are one window, whole,
so that a short item is found where it is the whole text; items that share an id but differ in text are each an item, documents likewise;
repeated rows count once; rows without an id are cleaned but not reported; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

# The patterns. Repeats are possessive, since Java would go a level deeper for each word of a long run; in SQL,
# whose patterns are never retried, they are plain.
JOINED = r"([0-9])[.,:/]([0-9])"
NUMBER = r"[0-9]++(?:[.,:/][0-9]++)*+"
MARKS = r"[^\p{L}\p{N}_]+"
NAME = r" \p{Lu}[\p{L}\p{N}_]*+"  # in words with one space before each
NAMES = rf"{NAME}(?:{NAME})*+"
UNITS = (
    "km|cm|mm|m|kg|g|mg|lb|oz|l|ml|s|min|h|hour|hours|minute|minutes|second|seconds|day|days|week|weeks|month|months|year|years|meter|meters|metre|metres|kilometer|kilometers|kilometre|kilometres|"
    "mile|miles|foot|feet|inch|inches|yard|yards|gram|grams|kilogram|kilograms|pound|pounds|ounce|ounces|liter|liters|litre|litres|dollar|dollars|cent|cents|euro|euros|percent|degree|degrees"
)
UNIT = rf"xnumx (?:{UNITS})( |$)"
SLOTS = ("xnumx", "xnamex", "xunitx")

# Letters whose capitals are other letters' too, and what stands for them where case does not count.
FOLDS = (("ß", "ss"), ("ς", "σ"))

#: Windows without a name that an item needs if they are to stand for it in texts of another case.
FREE = 3


def _spaced(text: Column) -> Column:
    """The words, case kept, with one space before each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, MARKS, " ")))


def _folded(text: Column) -> Column:
    for a, b in FOLDS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _template(text: Column, names: str | None) -> Column:
    named = _spaced(F.regexp_replace(F.coalesce(text, F.lit("")), NUMBER, "xnumx"))
    low = F.lower(F.regexp_replace(named, names, " xnamex")) if names else _folded(F.lower(named))
    return F.split(F.substring(F.regexp_replace(low, UNIT, "xnumx xunitx$1"), 2, 1 << 30), " ")


def template(text: Column, cased: bool = True) -> Column:
    """Words of the template. Without case no word is a name."""
    return _template(text, NAMES if cased else None)


def with_slots(texts: DataFrame, cased: bool = True) -> DataFrame:
    """``words`` of the template, ``said``: what stands in the text for each of them (column ``t``), and ``kinds``: the placeholder that each is, or null.

    With case the words of a name are one, joined by underscores in ``said``. Without case names are words like others, one by one; ``kinds`` tells
    which of them are capitalised.
    """
    joined = F.coalesce("t", F.lit(""))
    for _ in range(2):  # all parts of a number: each pass joins every other pair
        joined = F.regexp_replace(joined, JOINED, "$1_$2")
    each = texts.withColumns({"w": _template(F.col("t"), NAME), "p": F.split(F.lower(F.substring(_spaced(joined), 2, 1 << 30)), " ")})
    slot = lambda x: F.when(x.isin(*SLOTS), x)
    if not cased:
        each = each.withColumn("words", _template(F.col("t"), None))
        kinds = F.transform("words", lambda x, i: F.coalesce(slot(x), F.when(F.get("w", i) == "xnamex", F.lit("xnamex"))))
        return each.withColumns({"said": F.transform("p", _folded), "kinds": kinds}).drop("w", "p")
    name = lambda i: F.coalesce(F.get("w", i) == "xnamex", F.lit(False))
    each = each.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: ~((i > 0) & name(i) & name(i - 1))))
    said = F.transform("at", lambda i, k: F.array_join(F.slice("p", i + 1, F.coalesce(F.get("at", k + 1), F.size("p")) - i), "_"))
    each = each.withColumns({"words": F.transform("at", lambda i: F.get("w", i)), "said": said}).drop("w", "p", "at")
    return each.withColumn("kinds", F.transform("words", slot))


def windows(texts: DataFrame, window: int) -> DataFrame:
    """(key, i, h): hash of the window at word i; fewer words are one window. ``texts`` has key and words.

    One pass and no filter before the outer explode, under which the template would be worked out again for each.
    """
    starts = F.when(F.col("words")[0] != "", F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))))
    at = texts.select("key", "words", F.explode_outer(starts).alias("i"))
    full = F.xxhash64(*[F.get("words", F.col("i") + j) for j in range(window)])
    h = F.when(F.size("words") >= window, full).otherwise(F.xxhash64(F.array_join("words", " "), F.lit("whole")))
    return at.select("key", "i", h.alias("h")).filter("i is not null")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, t): rows of one id and one text share a key."""
    rows = df.select(F.col(base.quoted(id_col)).alias("id"), F.col(base.quoted(text_col)).alias("t"))
    return rows.select(F.xxhash64(F.col("id").isNull(), "id", "t").alias("key"), "id", "t")


def _wanted(parts: DataFrame, window: int, cased: bool) -> DataFrame:
    """(item, h, j): an item's distinct windows, each where it first stands. Without case those that hold none of the item's names, if there
    are ``FREE`` of them; else all."""
    at = windows(parts.select(F.col("item").alias("key"), "words"), window)
    if cased:
        return at.groupBy(F.col("key").alias("item"), "h").agg(F.min("i").alias("j"))
    named = parts.select(F.col("item").alias("key"), "kinds")
    holds = F.exists(F.slice("kinds", F.col("i") + 1, F.lit(window)), lambda x: x.isNotNull() & (x == "xnamex"))
    free = at.join(named, "key").select("key", "i", "h", (~F.coalesce(holds, F.lit(False))).alias("free"))
    each = free.groupBy(F.col("key").alias("item"), "h").agg(F.min("i").alias("j"), F.bool_and("free").alias("free"))
    enough = each.groupBy("item").agg((F.count_if("free") >= FREE).alias("enough"))
    return each.join(enough, "item").filter("free or not enough").select("item", "h", "j")


def _both(read) -> DataFrame:
    """What ``read`` makes with case, and without it, in one table with the column ``cased``."""
    return read(True).withColumn("cased", F.lit(True)).unionByName(read(False).withColumn("cased", F.lit(False)))


def _apart(name: str, cased: bool) -> Column:
    """A hash, other for each way to read: items and windows of the two never meet."""
    return (F.col(name) if cased else F.xxhash64(name, F.lit("without case"))).alias(name)


def _views(texts: DataFrame, items: DataFrame, window: int, least: float, consistent: float, broadcast_windows: int) -> DataFrame:
    """(cased, key, item, n_windows, n_found, n_slots, consistency) by both ways to read texts and items, with case and without it, in the same jobs."""
    parts = base.materialised(_both(lambda c: with_slots(items, c).select("key", F.col("key").alias("item"), "words", "said", "kinds").withColumn("item", _apart("item", c))))
    of = lambda df, c: df.filter("cased" if c else "not cased").drop("cased")
    wanted = base.materialised(_both(lambda c: _wanted(of(parts, c), window, c).select("item", _apart("h", c), "j")))
    hashes = wanted.select("h").distinct()
    side = F.broadcast(hashes) if hashes.count() <= broadcast_windows else hashes
    read = lambda c: windows(texts.select("key", template(F.col("t"), c).alias("words")), window).select("key", "i", _apart("h", c)).join(side, "h")
    hits = base.materialised(read(True).unionByName(read(False)).distinct())

    # The item's rarest windows, one more than a pair may lack.
    often = hits.groupBy("h").agg(F.count("*").alias("n"))
    totals = wanted.groupBy("item").agg(F.count("*").alias("n_windows"), F.bool_and("cased").alias("cased"))
    ranked = wanted.join(often, "h").withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy("n", "h"))).join(totals, "item")
    # Windows that no text has are not among the ranked ones; a pair lacks them all, and may lack so many fewer others.
    absent = F.col("n_windows") - F.count("*").over(Window.partitionBy("item"))
    probes = ranked.withColumn("spare", F.floor(F.col("n_windows") - F.ceil(F.lit(least) * F.col("n_windows") - 1e-9)) - absent).filter((F.col("spare") >= 0) & (F.col("r") <= F.col("spare") + 1)).select("item", "h")
    near = hits.select("key", "h").distinct()
    asked = base.materialised(near.join(probes, "h").select("key", "item").distinct())
    found = asked.join(wanted.select("item", "h"), "item").join(near, ["key", "h"]).groupBy("key", "item").agg(F.count("*").alias("n_found"))
    close = base.materialised(found.join(totals, "item").filter(F.col("n_found") >= F.lit(least) * F.col("n_windows")))

    votes = close.select("key", "item").join(wanted, "item").join(hits, ["key", "h"]).groupBy("key", "item", (F.col("i") - F.col("j")).alias("shift")).agg(F.count("*").alias("n"))
    shifts = votes.groupBy("key", "item").agg(F.max(F.struct("n", (-F.col("shift")).alias("back"))).alias("top")).select("key", "item", (-F.col("top.back")).alias("shift"))
    places = parts.select("item", "cased", "said", "words", F.posexplode("kinds").alias("s", "kind")).select("item", "cased", "s", F.get("said", F.col("s")).alias("value"), F.get("words", F.col("s")).alias("word"), F.col("kind").isNotNull().alias("slot"))
    places = places.filter("slot or not cased")
    near_texts = base.materialised(texts.join(close.select("key", "cased").distinct(), "key").dropDuplicates(["key", "cased"]))
    spoken = _both(lambda c: with_slots(of(near_texts, c), c).select("key", "said", F.col("words").alias("there")))
    there = lambda c: F.get(c, (F.col("s") + F.col("shift")).cast("int"))
    met = shifts.join(places, "item").join(spoken, ["key", "cased"]).select("key", "item", "value", "slot", there("said").alias("met"), F.coalesce(there("there") == F.col("word"), F.lit(False)).alias("same"))
    per_value = met.groupBy("key", "item", "slot", F.when(F.col("slot"), F.col("value")).alias("value")).agg(((F.countDistinct("met") == 1) & (F.count("met") == F.count("*"))).cast("int").alias("ok"), F.count_if("same").alias("n_same"), F.count("*").alias("n"))
    verdict = per_value.groupBy("key", "item").agg(F.count_if("slot").alias("n_slots"), F.avg(F.when(F.col("slot"), F.col("ok"))).alias("consistency"), F.sum(F.when(~F.col("slot"), F.col("n_same"))).alias("n_same"), F.sum(F.when(~F.col("slot"), F.col("n"))).alias("n_fixed"))
    out = close.join(verdict, ["key", "item"], "left")
    out = out.select("cased", "key", "item", "n_windows", "n_found", F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"), F.coalesce("consistency", F.lit(1.0)).alias("consistency"), F.coalesce("n_same", F.lit(0)).alias("n_same"), F.coalesce("n_fixed", F.lit(0)).alias("n_fixed"))
    # Without case few windows may stand for the item, so its fixed words have to stand where they belong.
    out = out.filter(F.col("cased") | (F.col("n_same") >= F.lit(least) * F.col("n_fixed")))
    return out.filter(F.col("consistency") >= consistent).drop("n_same", "n_fixed").join(parts.select("item", F.col("key").alias("of")), "item").drop("item").withColumnRenamed("of", "item")


def _pairs(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, least: float, consistent: float, broadcast_windows: int) -> DataFrame:
    """(key, item, n_windows, n_found, n_slots, consistency), items and texts by the hash of id and text: what is found with case, and what is
    found without it besides."""
    texts = _keyed(docs, id_col, text_col)
    items = _keyed(benchmark, item_col, item_text_col).filter("id is not null").dropDuplicates(["key"])
    found = base.materialised(_views(texts, items, window, least, consistent, broadcast_windows))
    cased, plain = (found.filter(c).drop("cased") for c in ("cased", "not cased"))
    return cased.unionByName(plain.join(cased.select("key", "item"), ["key", "item"], "left_anti"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 5, least: float = 0.8, consistent: float = 0.8, broadcast_windows: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found, coverage, n_slots, consistency) of every pair of a text and an item that counts."""
    pairs = base.materialised(_pairs(docs, benchmark, id_col, text_col, item_col, item_text_col, window, least, consistent, broadcast_windows))
    ids = _keyed(docs, id_col, text_col).select("key", F.col("id").alias("doc_id")).join(pairs.select("key").distinct(), "key").distinct()
    names = _keyed(benchmark, item_col, item_text_col).select(F.col("key").alias("item"), F.col("id").alias("item_id")).distinct()
    return pairs.join(ids, "key").join(names, "item").filter("doc_id is not null").select("doc_id", "item_id", "n_windows", "n_found", (F.col("n_found") / F.col("n_windows")).alias("coverage"), "n_slots", "consistency")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 5, least: float = 0.8, consistent: float = 0.8, broadcast_windows: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with their columns."""
    leaked = _pairs(docs, benchmark, id_col, text_col, item_col, item_text_col, window, least, consistent, broadcast_windows).select(F.col("key").alias("__leaked__")).distinct()
    i, t = F.col(base.quoted(id_col)), F.col(base.quoted(text_col))
    return docs.join(leaked, F.xxhash64(i.isNull(), i, t) == F.col("__leaked__"), "left_anti")


def oracle(documents: str = "documents", window: int = 5) -> str:
    """DuckDB SQL for ``contaminated`` at its defaults: both ways to read, one after the other."""
    rx = lambda t, p, to: f"regexp_replace({t}, '{p.replace('++', '+').replace('*+', '*')}', '{to}', 'g')"
    spaced = lambda t: f"concat(' ', trim({rx(t, MARKS, ' ')}))"
    text, both = "coalesce(text, '')", chr(92) + "1_" + chr(92) + "2"
    plain = f"string_split(lower(substring({spaced(rx(rx(text, JOINED, both), JOINED, both))}, 2)), ' ')"
    numbered = spaced(rx(text, NUMBER, "xnumx"))
    words = lambda t: f"string_split(substring({rx(t, UNIT, 'xnumx xunitx' + chr(92) + '1')}, 2), ' ')"

    def folded(t: str) -> str:
        for x, y in FOLDS:
            t = f"replace({t}, '{x}', '{y}')"
        return t

    slots = ", ".join(f"'{s}'" for s in SLOTS)
    rows = lambda name, key, table: f"{name}0 AS MATERIALIZED (SELECT *, row_number() OVER () AS k FROM (SELECT DISTINCT {key}, text FROM {table} WHERE {key} IS NOT NULL))"
    cut = lambda v, name: f"{v}{name}w AS (SELECT k, i, array_to_string(w[i + 1:i + {window}], ' ') AS g, list_contains(kinds[i + 1:i + {window}], 'xnamex') AS named FROM (SELECT k, w, kinds, unnest(range(0, len(w) - {window} + 1)) AS i FROM {v}{name} WHERE len(w) >= {window}) UNION ALL SELECT k, 0, 'whole ' || array_to_string(w, ' '), list_contains(kinds, 'xnamex') FROM {v}{name} WHERE len(w) < {window})"

    merged = "[w[i] FOR i IN st] AS w, [array_to_string(p[st[n]:coalesce(st[n + 1] - 1, len(p))], '_') FOR n IN range(1, len(st) + 1)] AS p"

    def side(v: str, name: str) -> str:
        if v == "c":
            own = (
                f"c{name}1 AS (SELECT k, {words(f"lower({rx(numbered, NAME, ' xnamex')})")} AS w, {plain} AS p FROM {name}0), "
                f"c{name}2 AS (SELECT k, w, p, [i FOR i IN range(1, len(w) + 1) IF NOT (i > 1 AND w[i] = 'xnamex' AND w[i - 1] = 'xnamex')] AS st FROM c{name}1 WHERE w[1] <> ''), "
                f"c{name} AS (SELECT *, [CASE WHEN x IN ({slots}) THEN x END FOR x IN w] AS kinds FROM (SELECT k, {merged} FROM c{name}2))"
            )
        else:
            own = f"u{name} AS (SELECT k, w, p, [CASE WHEN w[i] IN ({slots}) THEN w[i] WHEN n[i] = 'xnamex' THEN 'xnamex' END FOR i IN range(1, len(w) + 1)] AS kinds FROM (SELECT k, {words(folded(f"lower({numbered})"))} AS w, list_transform({plain}, lambda x: {folded("x")}) AS p, {words(f"lower({rx(numbered, NAME, ' xnamex')})")} AS n FROM {name}0) WHERE w[1] <> '')"
        return f"{own}, {cut(v, name)}"

    def view(v: str) -> str:
        wanted = "SELECT item, g, j FROM z" if v == "c" else f"SELECT item, g, j FROM (SELECT *, count(*) FILTER (free) OVER (PARTITION BY item) AS n FROM z) WHERE free OR n < {FREE}"
        agree = "" if v == "c" else "AND coalesce(n_same, 0) >= 0.8 * coalesce(n_fixed, 0)"
        return f"""{side(v, "d")}, {side(v, "b")},
{v}bj AS (WITH z AS (SELECT k AS item, g, min(i) AS j, bool_and(NOT named) AS free FROM {v}bw GROUP BY 1, 2) {wanted}),
{v}hits AS (SELECT DISTINCT d.k AS doc, item, g, i - j AS shift FROM {v}dw d JOIN {v}bj USING (g)),
{v}close AS (SELECT doc, item, n_found, n_windows FROM (SELECT doc, item, count(DISTINCT g) AS n_found FROM {v}hits GROUP BY 1, 2) JOIN (SELECT item, count(*) AS n_windows FROM {v}bj GROUP BY 1) USING (item) WHERE n_found >= 0.8 * n_windows),
{v}shifts AS (SELECT doc, item, shift FROM (SELECT doc, item, shift, row_number() OVER (PARTITION BY doc, item ORDER BY count(*) DESC, shift) AS r FROM {v}hits GROUP BY 1, 2, 3) WHERE r = 1),
{v}places AS (SELECT k AS item, s, p[s + 1] AS value, w[s + 1] AS word, kinds[s + 1] IS NOT NULL AS slot FROM (SELECT k, w, p, kinds, unnest(range(0, len(w))) AS s FROM {v}b)),
{v}near AS MATERIALIZED (SELECT * FROM {"cd2" if v == "c" else "ud"} WHERE k IN (SELECT doc FROM {v}close)),
{v}there AS (SELECT k, unnest(range(0, len(w))) AS place, unnest(w) AS w, unnest(p) AS p FROM {f"(SELECT k, {merged} FROM cnear)" if v == "c" else "unear"}),
{v}met AS (SELECT c.doc, c.item, value, slot, d.p AS met, d.w = word AS same FROM {v}close c JOIN {v}shifts USING (doc, item) JOIN {v}places USING (item) LEFT JOIN {v}there d ON d.k = c.doc AND d.place = s + shift),
{v}values AS (SELECT doc, item, slot, CASE WHEN slot THEN value END AS value, CASE WHEN count(DISTINCT met) = 1 AND count(met) = count(*) THEN 1 ELSE 0 END AS ok, count_if(same) AS n_same, count(*) AS n FROM {v}met GROUP BY 1, 2, 3, 4),
{v}verdict AS (SELECT doc, item, count_if(slot) AS n_slots, avg(ok) FILTER (slot) AS consistency, sum(n_same) FILTER (NOT slot) AS n_same, sum(n) FILTER (NOT slot) AS n_fixed FROM {v}values GROUP BY 1, 2),
{v}out AS (SELECT doc, item, n_windows, n_found, coalesce(n_slots, 0) AS n_slots, coalesce(consistency, 1.0) AS consistency FROM {v}close LEFT JOIN {v}verdict USING (doc, item) WHERE coalesce(consistency, 1.0) >= 0.8 {agree})"""

    return f"""WITH {rows("d", "doc_id", documents)}, {rows("b", "item_id", "benchmark")}, {view("c")}, {view("u")},
every AS (SELECT * FROM cout UNION ALL SELECT * FROM uout WHERE NOT EXISTS (SELECT 1 FROM cout WHERE cout.doc = uout.doc AND cout.item = uout.item))
SELECT doc_id, item_id, n_windows, n_found, CAST(n_found AS DOUBLE) / n_windows AS coverage, n_slots, consistency FROM every JOIN d0 ON d0.k = doc JOIN b0 ON b0.k = item"""
