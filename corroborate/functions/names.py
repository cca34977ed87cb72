"""Column functions over names, ratings and free text. All are built-in expressions, safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_name(c: Column | str) -> Column:
    """struct(genus, species, cultivar, is_genus_only) of a scientific name; an empty name gives nulls.

    The first quoted part is the cultivar, all quoted parts go. A closing sp. or spp. means the genus; a hybrid mark counts as second
    word only; a rank, or a capitalised word without a full stop, in the species' place is none.
    """
    raw = F.coalesce(_col(c), F.lit(""))
    cultivar = F.nullif(F.regexp_extract(raw, "'([^']+)'", 1), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(raw, "'[^']+'", ""), r"^\s+|\s+$", "")
    words = F.split(bare, r"\s+")
    genus = F.nullif(F.get(words, F.lit(0)), F.lit(""))
    second = F.when(F.get(words, F.lit(1)).isin("x", "×"), F.get(words, F.lit(2))).otherwise(F.get(words, F.lit(1)))
    generic = bare.rlike(r"(?i)\bspp?\.?\s*$")
    rank = second.rlike(r"(?i)^(var|subsp|f)\.?$")
    author = second.rlike("^[A-Z]") & ~second.contains(".")
    species = F.when(~generic & (second != "") & ~rank & ~author, second)
    return F.struct(genus.alias("genus"), species.alias("species"), cultivar.alias("cultivar"), (species.isNull() & genus.isNotNull()).alias("is_genus_only"))


def parse_full_name(c: Column | str) -> Column:
    """struct(genus, species, authority): first word, second word, the rest."""
    words = F.split(F.trim(_col(c)), r"\s+")
    rest = F.when(F.size(words) > 2, F.array_join(F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(1))), " "))
    return F.struct(F.get(words, F.lit(0)).alias("genus"), F.get(words, F.lit(1)).alias("species"), rest.alias("authority"))


def parse_botanical(c: Column | str) -> Column:
    """struct(name, cultivar): the text around a quoted cultivar, and the cultivar."""
    raw = _col(c)
    pattern = r"^(.*?)\s*['‘]([^'’]+)['’]\s*(.*)$"
    hit = raw.rlike(pattern)
    name = F.when(hit, F.trim(F.concat_ws(" ", F.regexp_extract(raw, pattern, 1), F.regexp_extract(raw, pattern, 3)))).otherwise(F.trim(raw))
    return F.struct(name.alias("name"), F.when(hit, F.regexp_extract(raw, pattern, 2)).alias("cultivar"))


def strip_author(c: Column | str) -> Column:
    """Everything from the first capitalised later word on goes."""
    return F.regexp_replace(_col(c), r"\s+[A-Z][a-z]*\.?.*$", "")


def binomial_key(genus: Column | str, species: Column | str) -> Column:
    return F.lower(F.trim(F.concat_ws(" ", _col(genus), _col(species))))


def similarity(a: Column | str, b: Column | str) -> Column:
    """1 less the edit distance over the longer length; 1 for two equal or two empty texts."""
    a, b = F.lower(F.coalesce(_col(a), F.lit(""))), F.lower(F.coalesce(_col(b), F.lit("")))
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


# Texts that stand for a missing value.
NULLISH = ("", "null", "unknown", "n/a")


def is_nullish(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(_col(c))).isin(*NULLISH), F.lit(True))


# Keywords of attribute categories, the first that matches wins.
CATEGORY_WORDS = (("fire", ("fire", "flammab")), ("water", ("water", "drought", "irrigation")), ("deer", ("deer", "browse")), ("native", ("native", "origin")), ("invasive", ("invasiv",)), ("wildlife", ("pollinat", "bird", "wildlife", "lepidopt")))


def attribute_category(c: Column | str) -> Column:
    out = F.lit("other")
    for name, words in reversed(CATEGORY_WORDS):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.lower(_col(c)).contains(w)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def crosswalk(c: Column | str, mapping: Mapping[str, tuple[str, str]]) -> Column:
    """struct(code, label) by dictionary; unknown values give (null, the value)."""
    out = F.struct(F.lit(None).cast("string").alias("code"), _col(c).alias("label"))
    for value, (code, label) in mapping.items():
        out = F.when(F.trim(_col(c)) == value, F.struct(F.lit(code).alias("code"), F.lit(label).alias("label"))).otherwise(out)
    return out


def tier(c: Column | str, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the highest bound that the number reaches."""
    out = F.lit(default)
    for bound, label in sorted(bounds):
        out = F.when(_col(c) >= bound, F.lit(label)).otherwise(out)
    return out


def clean_text(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def strip_tags(c: Column | str) -> Column:
    return clean_text(F.regexp_replace(_col(c), "<[^>]*>", " "))


def flag_marker(c: Column | str, marker: str = "*!*") -> Column:
    """struct(text without the marker, whether it was there)."""
    return F.struct(clean_text(F.replace(_col(c), F.lit(marker), F.lit(" "))).alias("text"), _col(c).contains(marker).alias("flagged"))


def map_keywords(values: Column | str, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Array of struct(attribute, value) for each (keyword, attribute, value) that occurs in some element."""

    def some(k: str) -> Column:
        return F.coalesce(F.exists(_col(values), lambda v: F.lower(v).contains(k)), F.lit(False))

    hits = [F.when(some(k), F.struct(F.lit(a).alias("attribute"), F.lit(x).alias("value"))) for k, a, x in rules]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def keyword_rule(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str | None) -> Column:
    """The first rule any of whose words occurs."""
    out = F.lit(default)
    for name, words in reversed(list(rules)):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.coalesce(F.lower(_col(c)).contains(w), F.lit(False))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


# Keyword rules of source metadata.
METHODOLOGY = (
    ("meta_analysis", ("meta-analysis", "meta analysis")), ("experimental", ("experiment", "lab", "test")), ("field_observation", ("field", "observation", "survey")),
    ("literature_review", ("literature", "review", "compilation")), ("modeling", ("model", "simulation")), ("expert_opinion", ("expert", "opinion", "guide")),
)
SPECIFICITY = (("national", ("national", "united states", "us", "usa")), ("global", ("global", "worldwide", "international")))
STATES = ("oregon", "california", "washington", "idaho", "nevada", "montana")


def infer_methodology(c: Column | str) -> Column:
    """Null where no rule fits."""
    return keyword_rule(c, METHODOLOGY, None)


def infer_specificity(c: Column | str, word_boundary: bool = False) -> Column:
    """National or global by keyword, local if exactly one known state is named, else regional; null for no text.

    "us" counts wherever it stands, also inside a word, as in the fixed rule; so does "national" in "international". With ``word_boundary``
    keywords count as whole words only.
    """
    text = F.nullif(F.lower(_col(c)), F.lit(""))
    named = sum((text.contains(s).cast("int") for s in STATES), F.lit(0))
    if word_boundary:
        found = F.lit(None).cast("string")
        for value, words in reversed(SPECIFICITY):
            found = F.when(text.rlike(rf"\b({'|'.join(words)})\b"), F.lit(value)).otherwise(found)
    else:
        found = keyword_rule(text, SPECIFICITY, None)
    return F.when(text.isNotNull(), F.coalesce(found, F.when(named == 1, "local").otherwise("regional")))


def infer_currency(year: Column | str, as_of_year: int) -> Column:
    """By the number that the text starts with; null where there is none."""
    age = as_of_year - F.regexp_extract(_col(year), r"^\s*([+-]?[0-9]+)", 1).try_cast("long")
    return F.when(age <= 5, "current").when(age <= 15, "recent").when(age.isNotNull(), "dated")


def band(c: Column | str, bands: Sequence[tuple[int, int, str]], default: Column | str | None = None) -> Column:
    """Label of the band (low, high, label; both ends inside) that holds the first number of a text such as a page reference."""
    n = F.coalesce(F.regexp_extract(_col(c).cast("string"), "^([0-9]+)", 1).try_cast("int"), F.lit(0))
    out = default if isinstance(default, Column) else F.lit(default)
    for low, high, label in bands:
        out = F.when(n.between(low, high), F.lit(label)).otherwise(out)
    return out


def parse_range(c: Column | str) -> Column:
    """struct(low, high) of texts like '2-4 ft'; a single number is both."""
    numbers = F.regexp_extract_all(_col(c), F.lit(r"([0-9]+(?:\.[0-9]+)?)"), 1)
    low = F.get(numbers, F.lit(0)).try_cast("double")
    return F.struct(low.alias("low"), F.coalesce(F.get(numbers, F.lit(1)).try_cast("double"), low).alias("high"))


def extract_json(c: Column | str) -> Column:
    """The JSON in a model's answer: the answer itself, a fenced block, the outermost list, the outermost object."""
    trimmed = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    raw = trimmed(_col(c))
    tries = [raw, trimmed(F.regexp_extract(raw, r"(?s)```(?:json)?\s*(.*?)```", 1)), F.regexp_extract(raw, r"(?s)(\[.*\])", 1), F.regexp_extract(raw, r"(?s)(\{.*\})", 1)]
    return F.coalesce(*[F.when(t.rlike(r"^[\[{]") & F.try_parse_json(t).isNotNull(), t) for t in tries])


def validate_enum(c: Column | str, allowed: Sequence[str], default: str) -> Column:
    return F.when(_col(c).isin(*allowed), _col(c)).otherwise(F.lit(default))


def clamp(c: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _col(c)))
