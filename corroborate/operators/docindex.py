"""Outline index of documents: search, tree, outline, page chunks."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .grams import containing


def _asked(queries: DataFrame, least: int) -> DataFrame:
    """(query_id, asked): the distinct words of each query, in order."""
    words = F.filter(F.split(F.lower("query"), r"\s+"), lambda w: F.length(w) >= least)
    return queries.filter("query is not null").select("query_id", F.explode(words).alias("word")).groupBy("query_id").agg(F.array_sort(F.collect_set("word")).alias("asked"))


def _best(hits: DataFrame, lists: DataFrame, k: int, least: int = 1) -> DataFrame:
    """(asked, doc_id, node_id, score, rank): for each list of words the ``k`` nodes with most points, of those with ``least`` or more.

    ``hits``: doc_id, node_id, word, points. Nodes that hold the same words with the same points score alike for every list, so that only
    the first ``k`` of each such group can be among the best. A group meets the lists in the task that has it.
    """
    each = hits.repartition("doc_id", "node_id").groupBy("doc_id", "node_id", "word").agg(F.sum("points").alias("points"))
    held = each.groupBy("doc_id", "node_id").agg(F.array_sort(F.collect_list(F.struct("word", "points"))).alias("held"))
    first = held.withColumn("r", F.row_number().over(Window.partitionBy("held").orderBy("doc_id", "node_id"))).filter(F.col("r") <= k)
    alike = first.groupBy("held").agg(F.collect_list(F.struct("doc_id", "node_id")).alias("nodes"))
    met = alike.withColumn("h", F.explode("held")).select("held", "nodes", "h.*").join(lists.select("asked", F.explode("asked").alias("word")), "word")
    scored = met.groupBy("held", "asked").agg(F.sum("points").alias("score"), F.first("nodes").alias("nodes")).filter(F.col("score") >= least)
    nodes = scored.select("asked", "score", F.explode("nodes").alias("n")).select("asked", "n.*", "score")
    return nodes.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "doc_id", "node_id"))).filter(F.col("rank") <= k)


def search_nodes(nodes: DataFrame, queries: DataFrame, k: int = 5, offset: int = 0) -> DataFrame:
    """(query_id, doc_id, node_id, score, rank): three points for each query word in a title and one in a summary, over zero.

    Words of one letter do not count; repeated words of a query count once. Words are looked up in titles and summaries once for all
    queries, and queries of the same words are answered once.
    """
    asked = kept(_asked(queries, 2))
    lists = kept(asked.select("asked").distinct())
    fields = F.array(*[F.struct(F.lit(points).alias("points"), F.lower(c).alias("text")) for c, points in (("title", 3), ("summary", 1))])
    texts = nodes.select("doc_id", "node_id", F.explode(fields).alias("f")).select("doc_id", "node_id", "f.*").filter("text <> ''")
    best = _best(containing(texts, lists.select(F.explode("asked").alias("word"))), lists, offset + k)
    return asked.join(best.filter(F.col("rank") > offset), "asked").select("query_id", "doc_id", "node_id", "score", "rank")


def search_terms(nodes: DataFrame, queries: DataFrame, least: int = 2, cap: int = 10) -> DataFrame:
    """Nodes that hold at least ``least`` query words of three letters or more, with 500 characters of summary; the top ``cap``."""
    asked = kept(_asked(queries, 3))
    lists = kept(asked.select("asked").distinct())
    text = F.explode(F.array(F.lower(F.concat_ws(" ", "title", "summary")))).alias("text")
    texts = nodes.select("doc_id", "node_id", text, F.substring("summary", 1, 500).alias("summary"))
    hits = containing(texts.drop("summary"), lists.select(F.explode("asked").alias("word"))).withColumn("points", F.lit(1))
    best = kept(_best(hits, lists, cap, least).withColumnRenamed("score", "n_terms"))
    same = F.col("t.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("t.node_id").eqNullSafe(F.col("b.node_id"))
    said = texts.alias("t").join(best.alias("b"), same).filter(F.exists("asked", lambda w: F.col("text").contains(w))).select("b.*", "summary")
    said = said.groupBy("asked", "doc_id", "node_id", "n_terms", "rank").agg(F.min("summary").alias("summary"))
    return asked.join(said, "asked").select("query_id", "doc_id", "node_id", "n_terms", "summary", "rank")


def flatten_nodes(docs: DataFrame, key: str = "doc_name", tree: str = "structure") -> DataFrame:
    """(key, node_id, parent_id, depth, title, start_index, end_index, summary) of each node of a JSON tree; broken JSON has none."""

    def walk(frames):
        for f in frames:
            out = []
            for k, text in zip(f["k"], f["t"], strict=True):
                try:
                    top = json.loads(text or "[]")
                except ValueError:
                    top = []
                todo = [(n, None, 0) for n in reversed(top if isinstance(top, list) else [top])]
                while todo:
                    n, parent, depth = todo.pop()
                    if not isinstance(n, dict):
                        continue
                    out.append((k, n.get("node_id"), parent, depth, n.get("title"), n.get("start_index"), n.get("end_index"), n.get("summary")))
                    todo += [(c, n.get("node_id"), depth + 1) for c in reversed(n.get("nodes") or [])]
            yield pd.DataFrame(out, columns=[key, "node_id", "parent_id", "depth", "title", "start_index", "end_index", "summary"]).astype({"start_index": "Int64", "end_index": "Int64"})

    return docs.select(F.col(key).alias("k"), F.col(tree).alias("t")).mapInPandas(walk, f"{key} string, node_id string, parent_id string, depth int, title string, start_index long, end_index long, summary string")


def children(nodes: DataFrame, node_id: str) -> DataFrame:
    return nodes.filter(F.col("parent_id") == node_id)


def outline(toc: DataFrame, n_pages: DataFrame) -> DataFrame:
    """Parents by dotted code, and page ranges: a section ends where the next starts (the page before if that one starts its
    page), the last with the document; a preface is added if the first section starts after page 1.

    ``toc``: doc_id, code, title, page, starts_page; ``n_pages``: doc_id, pages.
    """
    order = F.transform(F.split("code", r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    w = Window.partitionBy("doc_id").orderBy("page", "ord")
    t = toc.withColumn("ord", order).join(n_pages, "doc_id")
    t = t.withColumns({"next_page": F.lead("page").over(w), "next_starts": F.lead("starts_page").over(w), "rn": F.row_number().over(w)})
    end = F.when(F.col("next_page").isNull(), F.col("pages")).otherwise(F.greatest(F.col("page"), F.col("next_page") - F.coalesce(F.col("next_starts").cast("int"), F.lit(0))))
    parent = F.when(F.col("code").contains("."), F.regexp_replace("code", r"\.[^.]*$", ""))
    codes = toc.select(F.col("doc_id").alias("d2"), F.col("code").alias("c2")).distinct()
    body = t.select("doc_id", "code", "title", F.col("page").alias("start_page"), end.alias("end_page"), parent.alias("p"))
    body = body.join(codes, (F.col("doc_id") == F.col("d2")) & (F.col("p") == F.col("c2")), "left").select("doc_id", "code", "title", "start_page", "end_page", F.col("c2").alias("parent_code"))
    preface = t.filter("rn = 1 and page > 1").select("doc_id", F.lit("0").alias("code"), F.lit("Preface").alias("title"), F.lit(1).alias("start_page"), (F.col("page") - 1).alias("end_page"), F.lit(None).cast("string").alias("parent_code"))
    return preface.unionByName(body)


def page_offset(pairs: DataFrame) -> DataFrame:
    """Most frequent physical less printed page of each document (of equals the first seen). ``pairs``: doc_id, seq, physical, printed."""
    d = pairs.filter("physical is not null and printed is not null").groupBy("doc_id", (F.col("physical") - F.col("printed")).alias("offset")).agg(F.count("*").alias("n"), F.min("seq").alias("at"))
    return d.groupBy("doc_id").agg(F.max_by("offset", F.struct("n", -F.col("at"))).alias("offset"))


def clip_pages(toc: DataFrame, n_pages: DataFrame) -> DataFrame:
    """Sections that start within the document; those beyond its end are dropped."""
    return toc.join(n_pages, "doc_id").filter("page <= pages").drop("pages")


def apply_offset(toc: DataFrame, offsets: DataFrame, n_pages: DataFrame) -> DataFrame:
    """Physical pages; sections beyond the document's end are dropped."""
    return clip_pages(toc.join(offsets, "doc_id", "left").withColumn("page", F.col("page") + F.coalesce("offset", F.lit(0))).drop("offset"), n_pages)


def chunk_pages(pages: DataFrame, max_tokens: int, overlap: int = 1) -> DataFrame:
    """(doc_id, chunk, first_page, last_page, tokens): pages in order, tokens being characters // 4.

    A document within the budget is one chunk. Otherwise a chunk ends before the page that would take it over the even size,
    half way between the budget and an equal share, and starts again with ``overlap`` pages of the one before.

    Where the chunk after a break at a page would break again follows from prefix sums alone, so every page has a pointer to the next break. The
    breaks are the pages that pointers reach from the start; pointers are doubled each round, so that a document of n chunks takes log2(n) + 1
    rounds of joins on (document, page number), which spread one long document over tasks. Equal page numbers go by size.
    """
    doc = Window.partitionBy("doc_id").orderBy("page", "t")
    size = F.floor(F.length(F.coalesce("text", F.lit(""))) / 4)
    p = pages.select("doc_id", "page", size.alias("t")).withColumns({"i": F.row_number().over(doc) - 1, "sum": F.sum("t").over(doc.rowsBetween(Window.unboundedPreceding, 0))})
    total = p.groupBy("doc_id").agg(F.max("sum").alias("total"), F.count("*").alias("n"))
    parts = F.ceil(F.col("total") / max_tokens)
    even = F.when(F.col("total") <= max_tokens, F.col("total")).otherwise(F.ceil((F.col("total") / parts + max_tokens) / 2))
    p = kept(p.join(total.withColumn("even", even), "doc_id"))
    # From a break at i a chunk starts ``overlap`` pages before it; before the first page stands a start of its own, i = -1.
    held = p.select("doc_id", (F.col("i") + overlap).cast("int").alias("i"), (F.col("sum") - F.col("t")).alias("base"))
    base = p.select("doc_id", "i", "n", "even").join(held, ["doc_id", "i"], "left").select("doc_id", "i", "n", (F.coalesce("base", F.lit(0)) + F.col("even")).alias("most"))
    base = base.unionByName(p.filter("i = 0").select("doc_id", F.lit(-1).alias("i"), "n", F.col("even").alias("most")))
    # The pages that fit, counted among the sums in order; the page after them is the next break.
    mixed = base.select("doc_id", "i", "n", F.col("most").alias("v"), F.lit(1).alias("k")).unionByName(p.select("doc_id", "i", "n", F.col("sum").alias("v"), F.lit(0).alias("k")))
    fit = F.count_if(F.col("k") == 0).over(Window.partitionBy("doc_id").orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0))
    jump = kept(mixed.withColumn("fit", fit).filter("k = 1").select("doc_id", "i", F.when(F.greatest("fit", F.col("i") + 1) < F.col("n"), F.greatest("fit", F.col("i") + 1)).cast("int").alias("to")))
    reached = kept(total.select("doc_id", F.lit(-1).alias("i"), F.lit(0).cast("long").alias("chunk")))
    step = 1
    while not jump.filter("to is not null").isEmpty():
        more = reached.join(jump.filter("to is not null"), ["doc_id", "i"]).select("doc_id", F.col("to").alias("i"), (F.col("chunk") + step).alias("chunk"))
        reached = kept(reached.unionByName(more))
        then = jump.select("doc_id", F.col("i").alias("to"), F.col("to").alias("to2"))
        jump = kept(jump.join(then, ["doc_id", "to"], "left").select("doc_id", "i", F.col("to2").alias("to")))
        step *= 2
    ends = reached.withColumn("next", F.lead("i").over(Window.partitionBy("doc_id").orderBy("chunk")))
    at = lambda c, name: p.select("doc_id", F.col("i").alias(c), F.col("page").alias(f"{name}_page"), F.col("sum").alias(f"{name}_sum"), F.col("t").alias(f"{name}_t"))
    out = ends.join(total.select("doc_id", "n"), "doc_id").select("doc_id", "chunk", F.greatest(F.col("i") - overlap, F.lit(0)).cast("int").alias("a"), (F.coalesce("next", "n") - 1).cast("int").alias("z"))
    out = out.join(at("a", "first"), ["doc_id", "a"], "left").join(at("z", "last"), ["doc_id", "z"], "left")
    some = F.col("z") >= F.col("a")
    return out.select("doc_id", F.col("chunk").cast("int").alias("chunk"), F.when(some, F.col("first_page")).alias("first_page"), F.when(some, F.col("last_page")).alias("last_page"), F.when(some, F.col("last_sum") - F.col("first_sum") + F.col("first_t")).otherwise(0).cast("long").alias("tokens"))


def large_nodes(nodes: DataFrame, pages: DataFrame, n: int, m: int) -> DataFrame:
    """Sections over more than ``n`` pages and of at least ``m`` tokens."""
    p = pages.select(F.col("doc_id").alias("d"), "page", F.floor(F.length("text") / 4).alias("t"))
    j = nodes.join(p, (F.col("doc_id") == F.col("d")) & F.col("page").between(F.col("start_page"), F.col("end_page")))
    return j.groupBy("doc_id", "code").agg(F.count("*").alias("n_pages"), F.sum("t").alias("tokens")).filter((F.col("n_pages") > n) & (F.col("tokens") >= m))


def manifest(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("doc_id").agg(F.count_if(F.col("parent_id").isNull()).alias("n_roots"), F.count("*").alias("n_nodes"))


def index_status(docs: DataFrame, index: DataFrame) -> DataFrame:
    return docs.join(index, "doc_id", "left").withColumn("indexed", F.col("n_nodes").isNotNull()).withColumn("n_nodes", F.coalesce("n_nodes", F.lit(0)))
