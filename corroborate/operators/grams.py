"""Substring search by letter groups, in the place of a join on contains."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept

Q = 3
# So many words are looked for one by one; of more, so many are held beside the texts at once.
FEW, HELD = 64, 500_000


def grams(c: Column | str, q: int = Q) -> Column:
    """The distinct groups of ``q`` neighbouring characters, overlapping ones too, in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1)))


def containing(texts: DataFrame, words: DataFrame, text: str = "text", word: str = "word") -> DataFrame:
    """Rows of ``texts`` with each distinct word of ``words`` that they contain, case as given; empty words are in none.

    Up to FEW words are looked for in each text. Of more, a word is looked up by the one of its letter groups that is rarest in the texts
    (words shorter than a group by themselves), and then looked for in the texts that have that group. A word with a group that no text
    has is in none and meets no text. The texts stay where they are: they are not shuffled, but meet the words in their own tasks.
    """
    asked = words.select(F.col(word).alias("__w__")).filter("__w__ <> ''").distinct()
    some = [r[0] for r in asked.limit(FEW + 1).collect()]
    if len(some) <= FEW:
        each = F.array(*[F.lit(w) for w in some]).cast("array<string>")
        return texts.withColumn(word, F.explode(F.filter(each, lambda w: F.col(text).contains(w))))
    asked = kept(asked.select("__w__", F.least(F.length("__w__"), F.lit(Q)).alias("size")))
    sizes, n = asked.agg(F.collect_set("size"), F.count("*")).first()
    index = texts.withColumn("__g__", F.explode(F.array_distinct(F.concat(*[grams(text, q) for q in sorted(sizes)]))))
    own = F.when(F.col("size") == Q, grams("__w__")).otherwise(F.array("__w__"))
    common = index.groupBy("__g__").agg(F.count("*").alias("n"))
    rarest = asked.select("__w__", F.explode(own).alias("__g__")).join(common, "__g__", "left").groupBy("__w__").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "__g__")).alias("r"))
    rarest = kept(rarest.filter("r.n > 0").select("__w__", F.col("r.__g__").alias("__g__")))
    parts, hit = math.ceil(n / HELD), None
    for i in range(parts):
        held = rarest.filter(F.pmod(F.xxhash64("__w__"), F.lit(parts)) == i)
        part = index.join(F.broadcast(held), "__g__").filter(F.col(text).contains(F.col("__w__")))
        hit = part if hit is None else hit.unionByName(part)
    return hit.drop("__g__").withColumnRenamed("__w__", word)
