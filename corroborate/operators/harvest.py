"""Building datasets from tables, lists, lines, pages and nested records."""

from __future__ import annotations

from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import clean_text, strip_tags


def unpivot_regions(df: DataFrame, keys: list[str], regions: int, fields: list[str]) -> DataFrame:
    """region_<i>_<field> columns to one row a region."""
    rows = [F.struct(F.lit(i).alias("region"), *[F.col(f"region_{i}_{f}").alias(f) for f in fields]) for i in range(1, regions + 1)]
    return df.select(*keys, F.explode(F.array(*rows)).alias("r")).select(*keys, "r.*")


def explode_lists(df: DataFrame, key: str, fields: list[str], sep: str = r" \| ") -> DataFrame:
    """(key, attribute, value) of list-valued columns; empty items go."""
    items = F.explode(F.array(*[F.struct(F.lit(f).alias("attribute"), F.split(F.col(f), sep).alias("v")) for f in fields])).alias("x")
    return df.select(key, items).select(key, "x.attribute", F.explode("x.v").alias("value")).withColumn("value", F.trim("value")).filter("value <> ''")


def merge_states(df: DataFrame, key: str = "symbol", state: str = "state", order: str = "source_row") -> DataFrame:
    """First row of each key, and its states in the order first seen."""
    seen = df.groupBy(key, state).agg(F.min(order).alias("at")).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", state))), lambda s: s[state]).alias("states"))
    rest = [c for c in df.columns if c not in (key, state)]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("f")).select(key, "f.*")
    return first.join(seen, key)


def union_labelled(parts: list[tuple[str, DataFrame]], label: str = "rating") -> DataFrame:
    out = None
    for name, df in parts:
        part = df.withColumn(label, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def ffill_headers(lines: DataFrame, header: str, doc: str = "doc", line_no: str = "line_no") -> DataFrame:
    """Carry header lines (matching ``header``) down to the lines below them."""
    w = Window.partitionBy(doc).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    is_head = F.col("line").rlike(header)
    return lines.withColumn("header", F.last(F.when(is_head, F.trim("line")), ignorenulls=True).over(w)).filter(~is_head)


def join_continuations(lines: DataFrame, starts: str, doc: str = "doc", line_no: str = "line_no") -> DataFrame:
    """Lines that do not match ``starts`` are appended to the line above."""
    w = Window.partitionBy(doc).orderBy(line_no)
    group = F.sum(F.col("line").rlike(starts).cast("int")).over(w)
    return lines.withColumn("g", group).groupBy(doc, "g").agg(F.min(line_no).alias(line_no), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(line_no, "line"))), lambda s: F.trim(s["line"])), " ").alias("line")).drop("g")


class _Table:
    """An open table: its rows as a grid in which cells that span rows or columns stand in every place that they cover."""

    def __init__(self, number: int, name: str | None):
        self.number, self.name = number, name
        self.rows: list[tuple[int, list[str], bool, str | None]] = []
        self.spans: dict[int, tuple[int, str]] = {}  # by column: rows still to cover, and the text
        self.later: dict[int, tuple[int, str]] = {}
        self.row: list[str] | None = None
        self.text: list[str] | None = None
        self.spread, self.tall, self.head, self.link = 1, 1, False, None

    def start_row(self) -> None:
        self.end_row()
        self.row, self.head, self.link, self.later = [], False, None, {}

    def start_cell(self, tag: str, spread: int, tall: int) -> None:
        self.end_cell()
        if self.row is None:
            self.start_row()
        self.text, self.spread, self.tall, self.head = [], spread, tall, self.head or tag == "th"

    def _fill(self) -> None:
        """Places that cells of earlier rows cover."""
        while len(self.row) in self.spans:
            left, text = self.spans.pop(len(self.row))
            if left > 1:
                self.later[len(self.row)] = (left - 1, text)
            self.row.append(text)

    def end_cell(self) -> None:
        if self.text is None:
            return
        text = " ".join("".join(self.text).split())
        self._fill()
        for _ in range(self.spread):
            if self.tall > 1:
                self.later[len(self.row)] = (self.tall - 1, text)
            self.row.append(text)
        self.text = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row or self.row is not None and self.spans:
            self._fill()
            beyond = {c: (left - 1, text) for c, (left, text) in self.spans.items() if left > 1}  # columns that this row does not reach
            self.spans = beyond | self.later
            if self.row:
                self.rows.append((len(self.rows), self.row, self.head, self.link))
        self.row = None


class _Tables(HTMLParser):
    """All tables of a page. Open tables are a stack: an inner table's rows and text are its own, and the outer one goes on after it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Table] = []
        self.tables: list[_Table] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.tables.append(_Table(len(self.tables), a.get("id")))
            self.open.append(self.tables[-1])
        elif self.open and tag == "tr":
            self.open[-1].start_row()
        elif self.open and tag in ("td", "th"):
            self.open[-1].start_cell(tag, _span(a.get("colspan")), _span(a.get("rowspan")))
        elif self.open and tag == "a" and self.open[-1].text is not None:
            self.open[-1].link = a.get("href") or self.open[-1].link

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th"):
            self.open[-1].end_cell()
        elif tag == "tr":
            self.open[-1].end_row()
        elif tag == "table":
            self.open.pop().end_row()

    def handle_data(self, data):
        if self.open and self.open[-1].text is not None:
            self.open[-1].text.append(data)

    def close(self):
        super().close()
        while self.open:
            self.open.pop().end_row()


def _span(text: str | None) -> int:
    """Between 1 and 1,000, as browsers take it; anything else is 1."""
    text = (text or "").strip()
    return max(1, min(int(text), 1000)) if text.isascii() and text.isdigit() else 1


def html_tables(pages: DataFrame, key: str = "page_id", html: str = "html", table_id: str | None = None) -> DataFrame:
    """(key, table_no, table_id, row_no, cells, is_header, link) of every table row, or those of the tables with one id.

    Cells that span rows or columns are repeated in the places that they cover, so that a column stands at one place in every row. ``link``
    is the last link in a row's cells. Tables within cells are tables of their own, numbered in the order in which they open.
    """

    def parse(frames):
        for f in frames:
            out = []
            for k, h in zip(f["k"], f["h"], strict=True):
                p = _Tables()
                p.feed(h or "")
                p.close()
                out += [(k, t.number, t.name, *r) for t in p.tables if table_id is None or t.name == table_id for r in t.rows]
            yield pd.DataFrame(out, columns=[key, "table_no", "table_id", "row_no", "cells", "is_header", "link"])

    return pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInPandas(parse, f"{key} {dict(pages.dtypes)[key]}, table_no int, table_id string, row_no int, cells array<string>, is_header boolean, link string")


def table_slug(link: Column | str, folder: str = "plants") -> Column:
    """The part of a link after /folder/, up to the next slash or quote; null where there is none."""
    c = F.col(link) if isinstance(link, str) else link
    return F.nullif(F.regexp_extract(c, f'/{folder}/([^/"]+)', 1), F.lit(""))


def extract_labels(pages: DataFrame, key: str, html: str, labels: dict[str, str]) -> DataFrame:
    """(key, label, value): the first match of each pattern in the text without tags; none and n/a are dropped."""
    text = strip_tags(html)
    found = F.explode(F.array(*[F.struct(F.lit(k).alias("label"), clean_text(F.regexp_extract(text, p, 1)).alias("value")) for k, p in labels.items()])).alias("x")
    return pages.select(key, found).select(key, "x.*").filter(~F.lower("value").isin("", "none", "n/a"))


def definition_pairs(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, label, value) of dt/dd pairs."""
    pair = r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"
    names, values = F.regexp_extract_all(html, F.lit(pair), 1), F.regexp_extract_all(html, F.lit(pair), 2)
    return pages.select(key, F.explode(F.arrays_zip(names.alias("label"), values.alias("value"))).alias("x")).select(key, strip_tags("x.label").alias("label"), strip_tags("x.value").alias("value"))


# Patterns of traits in running text; every match counts.
TRAITS = {
    "heights": r"(?i)height:\s*([\d–\-\.]+\s*(?:inches|feet|inch|foot))",
    "spreads": r"(?i)spread:\s*([\d–\-\.]+\s*(?:inches|feet|inch|foot))",
    "zones": r"(?i)usda\s*hardiness\s*zones?:\s*([\d–\-]+)",
    "flowers": r"(?i)flowers?:\s*([^\n]{3,80})",
    "blooms": r"(?i)bloom\s*time:\s*([^\n]{3,60})",
}
# Signs of water use, the first that matches wins.
WATER_USE = (("Low", r"(?i)\bL\b.*(?:low water|minimal.*irrigation)"), ("Moderate", r"(?i)\bM\b.*(?:moderate|supplemental)"), ("High", r"(?i)\bH\b.*(?:high|needs.*irrigation)"))


def extract_traits(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, heights, spreads, zones, flowers, blooms, water_use, invasive_warning, native_hint) of each text; null reads as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    low = F.lower(t)
    water = F.lit("")
    for name, p in reversed(WATER_USE):
        water = F.when(t.rlike(p), F.lit(name)).otherwise(water)
    native = low.contains("native") & (low.contains("oregon") | low.contains("pacific northwest") | low.contains("western"))
    return docs.select(key, *[F.regexp_extract_all(t, F.lit(p), 1).alias(n) for n, p in TRAITS.items()], water.alias("water_use"), low.contains("invasive").alias("invasive_warning"), native.alias("native_hint"))


SPECIES = "struct<id:long,common_name:string,scientific_name:string,edible:boolean,flower:struct<color:array<string>,conspicuous:boolean>,foliage:struct<texture:string,color:array<string>,leaf_retention:boolean>,specifications:struct<growth_form:string,growth_habit:array<string>,growth_rate:string>,distribution:struct<native:array<string>>,duration:array<string>>"


# Attributes that species records fill (id, name), the codes of flower colours by the words that give them, native
# regions by the word that gives them, and habits: (words, whether a word inside a longer one counts, attribute).
NATIVE_STATUS, EDIBLE, FLOWER_COLOR = ("716f3d8f-195f-4d16-824b-6dd1e88767a6", "Native Status"), ("4afa9fb3-dd3c-4f46-bd99-5b584dc10605", "Edible Plant"), ("86a95833-886a-42bf-b149-c3754e9d913a", "Flower Color")
EVERGREEN, DECIDUOUS = ("f2ed9581-6d15-47ff-93c0-4259bccce5e1", "Evergreen"), ("fee87734-db6e-4c92-926f-bb606f529b6d", "Deciduous")
NATIVE_REGIONS = (("oregon", "oregon"), ("california", "california"))
COLORS = (("01", ("white", "cream", "green")), ("02", ("yellow", "gold")), ("03", ("orange",)), ("04", ("pink", "rose", "red", "brown")), ("05", ("purple", "lavender", "violet")), ("06", ("blue",)))
HABITS = (
    (("tree",), False, ("d5673c20-6fb7-49e3-b7e3-d056caf8d205", "Tree")), (("shrub",), False, ("ef9be401-1500-471b-bf8f-b11936d6d047", "Shrub")),
    (("vine",), False, ("eb566f0c-de5c-4981-9060-8ece5ab85997", "Vine")), (("graminoid", "grass"), True, ("f1108fb9-e629-4be3-99c1-bdae47ce0cf7", "Graminoid")),
    (("subshrub", "ground"), True, ("82f68242-238f-4567-bb47-90da80b5c338", "Groundcover")),
)


def species_to_warrants(payloads: DataFrame, entities: DataFrame) -> DataFrame:
    """(plant_id, attribute_id, attribute, value, source_value) from nested species records (column json), matched by lower-cased name.

    Five kinds: native regions known to the store, edible or not, growth habits, leaf retention (only where it is true: a record
    without it or with false says nothing), and codes of flower colours.
    """
    s = payloads.select(F.from_json("json", SPECIES).alias("s")).filter("s is not null")
    lower = lambda a: F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.lower(x))
    listed = lambda a: F.array_join(F.coalesce(a, F.array().cast("array<string>")), ", ")
    native, habits, colors = F.col("s.distribution.native"), F.col("s.specifications.growth_habit"), F.col("s.flower.color")

    def fact(attribute: tuple[str, str], hit, value, said):
        return F.when(hit, F.struct(F.lit(attribute[0]).alias("attribute_id"), F.lit(attribute[1]).alias("attribute"), value.alias("value"), said.alias("source_value")))

    def some(values, words, inside=True):
        return F.exists(lower(values), lambda x: F.coalesce(reduce(lambda p, q: p | q, [x.contains(w) if inside else x == w for w in words]), F.lit(False)))

    facts = [fact(NATIVE_STATUS, some(native, (word,)), F.lit(code), F.concat(F.lit("Native to: "), listed(native))) for word, code in NATIVE_REGIONS]
    facts.append(fact(EDIBLE, F.col("s.edible").isNotNull(), F.col("s.edible").cast("string"), F.concat(F.lit("edible: "), F.col("s.edible").cast("string"))))
    facts += [fact(attribute, some(habits, words, inside), F.lit("true"), F.concat(F.lit("growth_habit: "), listed(habits))) for words, inside, attribute in HABITS]
    facts.append(fact(EVERGREEN, F.coalesce("s.foliage.leaf_retention", F.lit(False)), F.lit("true"), F.lit("leaf_retention: true")))
    facts += [fact(FLOWER_COLOR, some(colors, words), F.lit(code), F.concat(F.lit("flower.color: "), listed(colors))) for code, words in COLORS]
    long = s.select(F.lower(F.trim("s.scientific_name")).alias("k"), F.explode(F.array_compact(F.array(*facts))).alias("x")).select("k", "x.*")
    e = entities.select(F.col("id").alias("plant_id"), F.lower(F.trim(F.concat_ws(" ", "genus", "species"))).alias("k"))
    return long.join(e, "k").drop("k").select("plant_id", "attribute_id", "attribute", "value", "source_value")


def build_references(parts: list[DataFrame]) -> DataFrame:
    """References of all lists, the first of each 30 characters of title and 20 of author; untitled ones all stay."""
    from .eav import dedup_first

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    title = F.trim(F.lower(F.coalesce("title", F.lit(""))))
    key = F.when(title != "", F.concat(F.substring(title, 1, 30), F.lit("|"), F.substring(F.lower(F.coalesce("author", F.lit(""))), 1, 20)))
    return dedup_first(out, key, ["list_no", "ref_number"])


# Triage classes by keyword of description, title and publisher, in order; the first that holds wins.
TRIAGE = (
    ("LIKELY_ONLINE", ("journal", "proceedings", "thesis", "university", "usda", "forest service", "extension", "bulletin", "research", "study", "doi")),
    ("CHECK_LIBRARIES", ("book", "press", "publishing", "macmillan", "timber press", "claremont")),
    ("CHECK_ARCHIVES", ("sunset", "magazine", "grounds maintenance")),
    ("LIKELY_ONLINE", ("department", "city of", "county", "fire", "state", "california", "forestry")),
    ("NEEDS_OUTREACH", ("nursery", "garden", "protect your", "homeowner", "green belt")),
)
TRIAGE_TYPES = (("trait_code", "LOW_PRIORITY"), ("dataset", "HAVE_IT"))
SEARCHES = {"google_scholar_url": "https://scholar.google.com/scholar?q=", "worldcat_url": "https://search.worldcat.org/search?q=", "google_search_url": "https://www.google.com/search?q="}
WAYBACK = "https://web.archive.org/web/*/"


def triage_refs(refs: DataFrame) -> DataFrame:
    """``triage`` of references (author, title, year, publisher, description, type, have_it; missing columns read as empty) and
    their search addresses; those at hand have none. Queries are the first author's last name, the title and a year of digits, 200 characters."""
    col = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in refs.columns else F.lit("")
    have, title, year = col("have_it") == "Yes", col("title"), col("year")
    text = F.lower(F.concat_ws(" ", col("description"), title, col("publisher")))
    kind = F.lit("TRY_ONLINE")
    for name, label in reversed(TRIAGE_TYPES):
        kind = F.when(col("type") == name, label).otherwise(kind)
    for label, words in reversed(TRIAGE):
        kind = F.when(text.rlike("|".join(words)), label).otherwise(kind)
    author = F.when(col("author") != "", F.trim(F.get(F.split(col("author"), ","), F.lit(0))))
    query = F.substring(F.concat_ws(" ", author, F.when(title != "", title), F.when(year.rlike("^[0-9]+$"), year)), 1, 200)
    asked = {"google_search_url": F.concat(query, F.lit(" filetype:pdf"))}
    urls = {n: F.when(~have & (query != ""), F.concat(F.lit(u), F.url_encode(asked.get(n, query)))).otherwise("") for n, u in SEARCHES.items()}
    urls["wayback_url"] = F.when(~have & (title != ""), F.concat(F.lit(WAYBACK), F.url_encode(F.substring(title, 1, 80)))).otherwise("")
    return refs.withColumns({"triage": F.when(have, "HAVE_IT").otherwise(kind), **urls})


def unique_with_sets(df: DataFrame, key: str, category: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key, category)]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("f"), F.array_sort(F.collect_set(category)).alias("categories")).select(key, "f.*", "categories")
