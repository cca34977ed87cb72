"""Readers and writers of source datasets. Source columns stay strings; nothing is inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _trimmed(df: DataFrame) -> DataFrame:
    cols = [F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in df.columns]
    out = df.select(*cols)
    blank = reduce(lambda a, b: a & b, [F.col(f"`{c}`") == "" for c in out.columns])
    return out.filter(~blank)


def read_source_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header: cells trimmed, blank rows dropped, missing trailing cells empty."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")
    return _trimmed(df.toDF(*[c.lstrip("﻿").strip() for c in df.columns]))


def with_source_row(df: DataFrame) -> DataFrame:
    """``source_file`` and ``source_row``: the row's number in its file, the header being row 1, of rows read from files.

    Rows of a split are counted where they are read, and the counts of a file's earlier splits, one row a split, are summed and joined
    back, so that files of many splits and folders of files are numbered without a sort or a single task. Rows that were dropped before
    have no number.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("__split__"), F.monotonically_increasing_id().alias("__at__"))
    sizes = at.groupBy("source_file", "__split__").agg(F.count("*").alias("__n__"), F.min("__at__").alias("__first__"))
    before = F.sum("__n__").over(Window.partitionBy("source_file").orderBy("__split__").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("source_file", "__split__", "__first__", F.coalesce(before, F.lit(0)).alias("__before__"))
    out = at.join(offsets, ["source_file", "__split__"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "source_file", (F.col("__before__") + F.col("__at__") - F.col("__first__") + 2).alias("source_row"))


def read_delimited(spark: SparkSession, path: str, sep: str, encoding: str = "UTF-8") -> DataFrame:
    """Delimited files with a header, columns named anew; short rows are filled with empty cells, surplus cells go."""
    return sanitize_columns(_trimmed(spark.read.csv(path, header=True, sep=sep, encoding=encoding, mode="PERMISSIVE", enforceSchema=True, quote="" if sep in "|\t" else '"')))


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Other characters than letters and digits in column names become one underscore."""
    import re

    return df.toDF(*[re.sub("[^0-9A-Za-z]+", "_", c).strip("_") or f"c{i}" for i, c in enumerate(df.columns)])


# Columns that may hold the name, in order.
NAME_COLUMNS = ("scientific_name", "botanical_name", "species", "taxon")


def scientific_name_col(df: DataFrame) -> Column:
    """First non-empty name column, else the genus followed by spp."""
    found = [F.nullif(F.trim(F.col(c)), F.lit("")) for c in NAME_COLUMNS if c in df.columns]
    if "genus" in df.columns:
        found.append(F.concat(F.nullif(F.trim(F.col("genus")), F.lit("")), F.lit(" spp.")))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def pick_source_files(spark: SparkSession, folder: str) -> list[str]:
    """plants.csv if it is a real file, else the plants_*.csv in order; pointer stubs of large-file storage are skipped.

    Pointers are small: only files of under a kilobyte are looked into, the others' contents are not read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "plants*.csv").load(folder)
    small = files.filter("length < 1024").filter(~F.col("content").cast("string").startswith("version https://git-lfs"))
    paths = sorted(r["path"] for r in small.select("path").union(files.filter("length >= 1024").select("path")).collect())  # names of files in one folder
    main = [p for p in paths if p.endswith("/plants.csv")]
    return main or [p for p in paths if "/plants_" in p]


def tables_from_sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """(table, columns, cells) for each row of the COPY blocks of a dump; \\N becomes empty.

    Lines are read as rows, in the order of their split's start and their number in it. What block a split begins in is carried over from
    the last head or end before it: one row for each split; within a split the last head or end above a line is its block.
    """
    at = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line_no"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), at.alias("at")).select("value", "file", "at.split", "at.line_no")
    head = r"^COPY (?:\w+\.)?(\S+) \(([^)]*)\) FROM stdin;$"
    mark = F.when(F.col("value").rlike(head), F.col("value")).when(F.col("value") == "\\.", "")
    marked = lines.withColumn("mark", mark)
    ends = marked.groupBy("file", "split").agg(F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("line_no"))).alias("last_mark"))
    carried = ends.withColumn("before", F.last("last_mark", ignorenulls=True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))).drop("last_mark")
    within = Window.partitionBy("file", "split").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    blocks = marked.join(carried, ["file", "split"]).withColumn("block", F.coalesce(F.last("mark", ignorenulls=True).over(within), "before"))
    rows = blocks.filter("mark is null and block <> '' and value <> ''")
    name = F.regexp_replace(F.regexp_extract("block", head, 1), '"', "")
    return rows.select(name.alias("table"), F.split(F.regexp_extract("block", head, 2), r",\s*").alias("columns"), F.transform(F.split("value", "\t"), lambda x: F.when(x == r"\N", "").otherwise(x)).alias("cells"))


def import_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """CSV mirrors with empty cells as nulls."""
    out = {}
    for name in names:
        df = spark.read.csv(f"{folder}/{name}.csv", header=True, multiLine=True, escape='"')
        out[name] = df.select(*[F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in df.columns])
    return out


def verify_counts(expected: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, expected, actual, ok) against a DataFrame (table, expected)."""
    actual = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("actual")).select(F.lit(n).alias("table"), "actual") for n, df in tables.items()])
    return expected.join(actual, "table", "full").withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def catalog_summary(tables: dict[str, DataFrame], embed: int = 200) -> DataFrame:
    """(table, n_rows, columns, rows as JSON where there are at most ``embed``)."""
    parts = []
    for name, df in tables.items():
        few = df.limit(embed + 1).select(F.to_json(F.struct("*")).alias("j")).agg(F.array_sort(F.collect_list("j")).alias("rows"))
        parts.append(df.agg(F.count("*").alias("n_rows")).crossJoin(few).select(F.lit(name).alias("table"), "n_rows", F.array(*[F.lit(c) for c in df.columns]).alias("columns"), F.when(F.col("n_rows") <= embed, F.col("rows")).alias("rows")))
    return reduce(DataFrame.unionByName, parts)


def write_by_member(df: DataFrame, list_col: str, path: str, sep: str = ",") -> None:
    """One folder for each member of a list column."""
    df.withColumn("member", F.explode(F.transform(F.split(list_col, sep), lambda x: F.trim(x)))).filter("member <> ''").write.partitionBy("member").parquet(path)


def profile_source(df: DataFrame, k: int = 20, order: str | None = None) -> DataFrame:
    """(column, n_rows, n_filled, values): up to ``k`` distinct non-empty values by first appearance (or in their order)."""
    at = F.col(order) if order else F.lit(0)
    cols = [c for c in df.columns if c != order]
    long = df.select(at.alias("at"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])).alias("x")).select("at", "x.*")
    counts = long.groupBy("column").agg(F.count("*").alias("n_rows"), F.count_if(F.trim("value") != "").alias("n_filled"))
    first = long.filter(F.trim("value") != "").groupBy("column", "value").agg(F.min("at").alias("at"))
    top = first.withColumn("r", F.row_number().over(Window.partitionBy("column").orderBy("at", "value"))).filter(F.col("r") <= k)
    lists = top.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "value"))), lambda s: s["value"]).alias("values"))
    return counts.join(lists, "column", "left")


def first_rows(df: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a source, as its profile shows them."""
    return df.orderBy(order).limit(n)


# What a dataset's papers say, and columns that tell a table of plants.
SOURCE_ID = r"\b([A-Z]{2,}-[0-9]{2,})\b"


def read_dataset_papers(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, text): README.md after DATA-DICTIONARY.md of each folder below ``root``, for ``dataset_registry``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    name, parent = F.regexp_extract("path", "([^/]+)$", 1), F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    some = files.select(parent.alias("dataset"), name.alias("name"), F.col("content").cast("string").alias("text")).filter(F.col("name").isin("DATA-DICTIONARY.md", "README.md"))
    return some.groupBy("dataset").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "text"))), lambda x: x["text"]), "\n").alias("text"))


def dataset_registry(readmes: DataFrame, counts: DataFrame) -> DataFrame:
    """(dataset, source_id, category, n_records): the README's number of records, else the counted rows.

    ``readmes`` has dataset and text, ``counts`` dataset and n_rows.
    """
    source_id = F.nullif(F.regexp_extract("text", SOURCE_ID, 1), F.lit(""))
    stated = F.replace(F.regexp_extract("text", r"([0-9][0-9,]*)\s+(?:records|rows|species|plants)", 1), F.lit(",")).try_cast("long")
    return readmes.join(counts, "dataset", "left").select("dataset", source_id.alias("source_id"), F.regexp_extract(source_id, "^([A-Z]+)", 1).alias("category"), F.coalesce(stated, F.col("n_rows")).alias("n_records"))


# Prefixes of source ids by category; other categories are their own, in capitals.
PREFIXES = {"fire": "FIRE", "deer": "DEER", "water": "WATER", "pollinators": "POLL", "birds": "BIRD", "native": "NATIVE", "invasive": "INVAS", "traits": "TRAIT", "taxonomy": "TAXON"}


def next_source_id(registry: DataFrame) -> DataFrame:
    """(category, next_id): one above the largest closing number of each category, two digits at least, after its prefix."""
    number = F.regexp_extract("source_id", "([0-9]+)$", 1).try_cast("int")
    known = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])
    top = registry.groupBy("category").agg((F.coalesce(F.max(number), F.lit(0)) + 1).cast("string").alias("n"))
    padded = F.when(F.length("n") < 2, F.lpad("n", 2, "0")).otherwise(F.col("n"))
    return top.select("category", F.concat(F.coalesce(F.try_element_at(known, F.col("category")), F.upper("category")), F.lit("-"), padded).alias("next_id"))
