"""A filter of urls: given rules of host and path, and for other urls rules mined by FP-growth from the ones that those judge.

Tokens of a url are its host's labels by depth from the right (h1:com), its path's segments by depth (p1:en), digits as 0, and the
names of its parameters (q:page). Distinct urls that a given rule fits are the labelled ones: each is a transaction of its tokens and its
verdict. Frequent combinations of up to ``longest`` tokens that imply a verdict with enough confidence become rules. They stand in an
inverted index under their rarest token; a url's known tokens are looked up there, and of the rules whose tokens it has all the one of
highest confidence, then support, then fewest tokens, then text, decides. A url without any is allowed.

Only DataFrame operations and the built-in FP-growth are used. Null urls and those without :// have an empty host and path, and fit no rule. FP-growth
follows combinations of any length, which double with every token. Where a url has over ``most_tokens`` frequent tokens, the combinations are
therefore grown a token at a time up to ``longest`` (``grown``): all frequent tokens of all urls count, however long. Repeated urls count once in the mining;
every row gets its own verdict. An empty table gives an empty one. Extra columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")
LABELS = tuple(f"={v}" for v in VERDICTS)
#: (action, host, path) as given for the pages.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
MIN_SUPPORT, MIN_CONFIDENCE, MOST_TOKENS, LONGEST = 0.01, 0.8, 12, 3
#: A bound that the SQL alone still has, beside that of MOST_TOKENS tokens a url.
MOST_FREQUENT = 4096


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _by_length(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))


def given(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and what it says; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in reversed(_by_length(rules)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    numbered = lambda kind: lambda x, i: F.concat(F.lit(kind), (i + 1).cast("string"), F.lit(":"), plain(x))
    labels = F.transform(F.reverse(F.filter(F.split(host, r"\."), lambda x: x != "")), numbered("h"))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), numbered("p"))
    asked = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit("[?&]([^=&#?]+)"), F.lit(1)), lambda x: F.concat(F.lit("q:"), plain(x)))
    return F.array_distinct(F.concat(labels, segments, asked))


def grown(baskets: DataFrame, least: int, min_confidence: float, longest: int) -> DataFrame:
    """(items, verdict, confidence, n) of all combinations of up to ``longest`` tokens that ``least`` rows of ``baskets`` (kept, verdict) hold with
    a verdict, by growing those of one token less. Equal rows are gathered first, so that the work follows the different ones.

    Combinations of as many rows as one of their parts are left out, with all that hold them: the part fits wherever they do, with the same
    figures and fewer tokens. So tokens that only occur together make pairs, but nothing longer.
    """
    whole = base.materialised(baskets.groupBy("kept", "verdict").agg(F.count("*").alias("w")).withColumn("id", F.monotonically_increasing_id()))
    each = base.materialised(whole.select("id", "verdict", "w", F.posexplode("kept").alias("at", "token")))
    rows, found, shorter = each.select("id", "verdict", "w", "at", F.array("token").alias("items")), None, None
    for size in range(1, longest + 1):
        said = [F.sum(F.when(F.col("verdict") == v, F.col("w")).otherwise(0)).alias(v) for v in VERDICTS]
        sets = rows.groupBy("items").agg(F.sum("w").alias("n"), *said).filter(F.greatest(*VERDICTS) >= least)
        if shorter is not None:
            parts = sets.withColumn("part", F.explode(F.transform("items", lambda x: F.array_remove("items", x)))).join(shorter.select(F.col("items").alias("part"), F.col("n").alias("n_part")), "part")
            sets = parts.filter("n_part > n").groupBy("items", "n", *VERDICTS).agg(F.count("*").alias("parts")).filter(F.col("parts") == size).drop("parts")
        shorter = base.materialised(sets)
        found = shorter if found is None else found.unionByName(shorter)
        longer = F.concat("items", F.array("token")).alias("items")
        rows = rows.join(shorter.select("items"), "items", "left_semi").join(each.select("id", F.col("at").alias("next"), "token"), "id").filter("next > at").select("id", "verdict", "w", F.col("next").alias("at"), longer)
    each_said = F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n")) for v in VERDICTS])).alias("x")
    said = found.select("items", F.col("n").alias("of"), each_said).select("items", "x.verdict", (F.col("x.n") / F.col("of")).alias("confidence"), "x.n")
    return said.filter((F.col("n") >= least) & (F.col("confidence") >= min_confidence))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, most_tokens: int = MOST_TOKENS, longest: int = LONGEST) -> DataFrame:
    """Rules (items, verdict, confidence, support, token) from (tokens, verdict), a row a url; ``token`` is the rarest of the items.

    Tokens of at least ``min_support`` of the urls count, so that there are at most the mean number of a url's tokens by 1 / ``min_support``.
    """
    spark, rules = labelled.sparkSession, "items array<string>, verdict string, confidence double, support double, token string"
    n = labelled.count()
    if not n:
        return spark.createDataFrame([], rules)
    top = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= F.ceil(F.lit(min_support) * n))
    known = top.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "token"))), lambda x: x["token"]).alias("known"))
    known = base.materialised(known)
    baskets = labelled.select(F.array_intersect(known.scalar(), "tokens").alias("kept"), "verdict")
    if baskets.agg(F.max(F.size("kept"))).first()[0] > most_tokens:
        found = grown(baskets, math.ceil(min_support * n), min_confidence, longest).withColumn("support", F.col("n") / n)
    else:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        marked = baskets.select(F.array_append("kept", F.concat(F.lit("="), "verdict")).alias("items"))
        found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence, numPartitions=parts).fit(marked).associationRules
        said = F.col("consequent")[0]
        found = found.filter(said.isin(*LABELS) & (F.size("antecedent") <= longest)).select(F.col("antecedent").alias("items"), F.substr(said, F.lit(2)).alias("verdict"), "confidence", "support")
    items = F.array_sort("items")
    rarest = F.array_max(F.transform(items, lambda x: F.struct(F.array_position("known", x).alias("at"), x.alias("token"))))["token"]
    return base.materialised(found.withColumn("known", known.scalar()).select(items.alias("items"), "verdict", "confidence", "support", rarest.alias("token")))


def decide(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, mined) for the distinct arrays of tokens ``key`` that some rule fits."""
    hit = keys.withColumn("token", F.explode("key")).join(rules, "token").filter(F.size(F.array_except("items", "key")) == 0)
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("items").alias("n"), F.array_join("items", ",").alias("t"), "verdict")
    return hit.groupBy("key").agg(F.min(order).alias("best")).select("key", F.col("best.verdict").alias("mined"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", keep: list[str] | None = None, **mining) -> DataFrame:
    """``keep`` columns with host, path, rule and verdict of every row."""
    keep = [c for c in (keep or pages.columns) if c not in ("host", "path", "rule", "verdict")]
    url = F.col("__url__")
    rows = pages.select(*[F.col(base.quoted(c)) for c in keep], F.col(base.quoted(url_col)).alias("__url__"))
    split = rows.withColumns(dict(zip(("host", "path"), host_and_path(url), strict=True)))
    split = split.withColumns(dict(zip(("rule", "verdict"), given(F.col("host"), F.col("path"), rules), strict=True)))
    labelled = split.filter("verdict is not null").select("__url__", "host", "path", "verdict").distinct()
    mined = mine(labelled.select(tokens(url, F.col("host"), F.col("path")).alias("tokens"), "verdict"), **mining)
    used = mined.select(F.explode("items").alias("t")).agg(F.array_sort(F.collect_set("t")).alias("used"))
    open_ = split.filter("verdict is null").withColumn("__key__", F.array_intersect(used.scalar(), tokens(url, F.col("host"), F.col("path"))))
    found = decide(open_.select(F.col("__key__").alias("key")).distinct(), mined).withColumnRenamed("key", "__key__")
    cols = [*[F.col(base.quoted(c)) for c in keep], "host", "path", "rule"]
    judged = open_.join(found, "__key__", "left").select(*cols, F.coalesce("mined", F.lit("allow")).alias("verdict"))
    return split.filter("verdict is not null").select(*cols, "verdict").unionByName(judged)


def oracle(rules: list[tuple[str, str, str]] | None = None) -> str:
    """DuckDB SQL of the query: combinations of tokens are counted by joining a url's tokens with each other."""
    rules = _by_length(RULES if rules is None else rules)
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{value(a, h, p)}'" for a, h, p in rules) + " END"
    plain = "regexp_replace(x, '[0-9]+', '0', 'g')"
    part = lambda array, kind: f"list_transform(list_filter({array}, lambda x: x <> ''), lambda x, i: concat('{kind}', i, ':', {plain}))"
    return f"""WITH cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
j AS (SELECT *, {case(lambda a, h, p: h + p)} AS rule, {case(lambda a, h, p: a)} AS verdict, list_distinct(list_concat({part("list_reverse(string_split(host, '.'))", "h")}, {part("string_split(path, '/')", "p")}, list_transform(regexp_extract_all(coalesce(url, ''), '[?&]([^=&#?]+)', 1), lambda x: concat('q:', {plain})))) AS tokens FROM hp),
lab AS (SELECT row_number() OVER () AS u, tokens, verdict FROM (SELECT DISTINCT url, host, path, tokens, verdict FROM j WHERE verdict IS NOT NULL)),
one AS (SELECT count(*) AS n FROM lab), each AS (SELECT u, verdict, unnest(tokens) AS token FROM lab),
freq AS (SELECT token, count(*) AS df FROM each GROUP BY 1 HAVING count(*) >= (SELECT ceil({MIN_SUPPORT} * n) FROM one) ORDER BY df DESC, token LIMIT {MOST_FREQUENT}),
kept AS (SELECT u, verdict, token FROM (SELECT u, verdict, token, row_number() OVER (PARTITION BY u ORDER BY df DESC, token) AS r FROM each JOIN freq USING (token)) WHERE r <= {MOST_TOKENS}),
sets AS (SELECT [token] AS items, verdict FROM kept UNION ALL SELECT [a.token, b.token], a.verdict FROM kept a JOIN kept b ON a.u = b.u AND a.token < b.token UNION ALL SELECT [a.token, b.token, c.token], a.verdict FROM kept a JOIN kept b ON a.u = b.u AND a.token < b.token JOIN kept c ON a.u = c.u AND b.token < c.token),
whole AS (SELECT items, count(*) AS n FROM sets GROUP BY 1),
rules AS (SELECT items, verdict, s.n / w.n::DOUBLE AS confidence, s.n AS support FROM (SELECT items, verdict, count(*) AS n FROM sets GROUP BY 1, 2) s JOIN whole w USING (items) WHERE s.n >= (SELECT ceil({MIN_SUPPORT} * n) FROM one) AND s.n / w.n::DOUBLE >= {MIN_CONFIDENCE}),
best AS (SELECT url, verdict FROM (SELECT k.url, r.verdict, row_number() OVER (PARTITION BY k.url ORDER BY confidence DESC, support DESC, len(items), array_to_string(items, ','), r.verdict) AS o FROM (SELECT DISTINCT url, tokens FROM j WHERE verdict IS NULL) k JOIN rules r ON list_has_all(k.tokens, r.items)) WHERE o = 1)
SELECT page_id, host, path, rule, coalesce(j.verdict, best.verdict, 'allow') AS verdict FROM j LEFT JOIN best ON j.url = best.url"""
