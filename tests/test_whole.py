"""Queries do their whole job: nothing that a scan could find is left out."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import duckdb

from corroborate.llm import url_filter
from corroborate.plans import registry

SF = "/root/testdata/sf0.001"


def test_audit_conflicts_cover_all_entities_and_attributes(spark):
    got = {(r.plant_id, r.attribute_id): (r.value_a, r.value_b, r.source_a, r.source_b) for r in registry.QUERIES["audit_conflicts"](spark, SF).collect()}
    lines = duckdb.sql(f"SELECT l_partkey, l_linenumber, l_orderkey, l_suppkey, l_quantity, l_returnflag || l_linestatus FROM '{SF}/lineitem.parquet' WHERE l_partkey IN (SELECT p_partkey FROM '{SF}/part.parquet')").fetchall()
    pairs, known = {}, set()
    for plant, attribute, order, supplier, quantity, flags in lines:
        value = "unknown" if (order + supplier) % 17 == 0 else flags
        if quantity > 45:
            known.add((plant, attribute, value))
        if supplier % 10:
            pairs.setdefault((plant, attribute), []).append((f"S{supplier}", value))
    want = {}
    for pair, said in pairs.items():
        if len({v for _, v in said}) > 1 and len({s for s, _ in said}) > 1:
            first = sorted((min(s for s, v in said if v == value), value) for value in {v for _, v in said} if (*pair, value) not in known)
            if len(first) > 1:
                (a, x), (b, y) = first[:2]
                want[pair] = (x, y, a, b)
    assert got == want
    assert any(plant % 5 == 0 for plant, _ in got) and any(attribute == 7 for _, attribute in got)


def _by_brute_force(urls, longest=3):
    """The mined verdicts: all combinations of up to three tokens of the labelled urls, counted one by one."""
    tokens = {}
    for u in urls:
        host, path = re.match(r"[a-z]+://([^/?#]*)([^?#]*)", u).groups()
        plain = lambda x: re.sub("[0-9]+", "0", x)
        named = [f"h{i + 1}:{plain(x)}" for i, x in enumerate(host.split(".")[::-1])] + [f"p{i + 1}:{plain(x)}" for i, x in enumerate(y for y in path.split("/") if y)]
        tokens[u] = frozenset(named), "allow" if host.endswith(".com") and path.startswith("/") else "block" if host.endswith(".net") and path.startswith(("/es/", "/fr/")) else None
    whole, said, n = Counter(), Counter(), sum(v is not None for _, v in tokens.values())
    for own, verdict in tokens.values():
        if verdict:
            for k in range(1, longest + 1):
                for c in combinations(sorted(own), k):
                    whole[c] += 1
                    said[c, verdict] += 1
    rules = [(-m / whole[c], -m, len(c), ",".join(c), v, set(c)) for (c, v), m in said.items() if m >= math.ceil(0.01 * n) and m / whole[c] >= 0.8]
    return {u: min((r[:5] for r in rules if r[5] <= own), default=(0, 0, 0, "", "allow"))[4] for u, (own, verdict) in tokens.items() if verdict is None}


def test_urls_of_many_frequent_tokens_are_mined_whole(spark):
    rnd = random.Random(7)
    words = [[f"{a}{chr(97 + i)}" for a in "uvwxyz"] for i in range(15)]
    path = lambda: "/".join(rnd.choice(w) for w in words)
    # Every labelled url has 13 tokens before the two that tell: with the 12 most frequent ones alone, these never count.
    common = "/".join(f"c{chr(97 + i)}" for i in range(11))
    urls = [f"http://a.net/fr/{common}/bad/{x}" for x in "abcdefghij"] + [f"http://a.com/de/{common}/good/{x}" for x in "abcdefghij"] + [f"http://a.com/de/{common}/x{i}/" for i in "klmnopqrst"]
    urls += [f"http://a.org/it/{common}/{x}/b" for x in ("bad", "good", "other")] + [f"http://{h}/{path()}" for h in ("a.com", "b.com", "a.org", "b.org") for _ in range(3)] + [f"http://b.net/es/{path()}" for _ in range(3)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.url: r.verdict for r in url_filter.judge(df, url_filter.RULES).collect()}
    want = _by_brute_force(urls)
    assert {u: got[u] for u in want} == want
    assert got[f"http://a.org/it/{common}/bad/b"] == "block"


def test_growing_and_fp_growth_find_the_same_rules_that_decide(spark):
    rnd = random.Random(3)
    urls = [f"http://{rnd.choice('abc')}.{rnd.choice(['com', 'net', 'org', 'net'])}/{rnd.choice(['fr', 'es', 'de'])}/{rnd.choice('xyz')}/{rnd.choice('pq')}" for _ in range(300)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    judged = [sorted((r.page_id, r.verdict) for r in url_filter.judge(df, url_filter.RULES, most_tokens=m).collect()) for m in (12, 1)]
    assert judged[0] == judged[1]


def test_a_very_long_labelled_url_among_few(spark):
    urls = ["http://a.com/" + "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))] + [f"http://{x}.com/a" for x in "bcdef"] + ["http://x.org/sba", "http://x.org/saa"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(df, url_filter.RULES).collect()} == {"allow"}


def test_stars_take_no_round_of_components(spark, monkeypatch):
    from corroborate.llm import components as module

    rounds, star = [], module._star
    monkeypatch.setattr(module, "_star", lambda edges, large: rounds.append(large) or star(edges, large))
    found = lambda rows: {(r.node, r.component) for r in module.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found([(1, i) for i in range(2, 9)] + [(30, 20), (20, 30), (5, 5)]) == {(i, 1) for i in range(2, 9)} | {(30, 20)} and not rounds
    assert found([]) == set() and not rounds
    # A chain of two edges is hung on its least node in one round, which is the last.
    assert found([(1, 2), (2, 3)]) == {(2, 1), (3, 1)} and len(rounds) == 2
    assert found([(i, i + 1) for i in range(-20, 20)]) == {(i, -20) for i in range(-19, 21)}


def test_edges_joined_up_in_tasks_need_few_rounds(spark, monkeypatch):
    from corroborate.llm import components as module

    rounds, star = [], module._star
    monkeypatch.setattr(module, "_star", lambda edges, large: rounds.append(large) or star(edges, large))
    chain = spark.createDataFrame([(i, i + 1) for i in range(-20, 20)] + [(50, 40), (None, 3)], "a long, b long")
    assert {(r.node, r.component) for r in module.components(chain.coalesce(1), joined_up=True).collect()} == {(i, -20) for i in range(-19, 21)} | {(50, 40)}
    assert len(rounds) <= 2
    # Cut into pieces, edges still connect the same nodes, and no piece has more of them than it was given.
    import pyarrow as pa

    monkeypatch.setattr(module, "HELD_EDGES", 4)
    rnd = random.Random(5)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(70)]
    batches = [pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges[i : i + 3]], pa.int64()) for k in (0, 1)], names=["a", "b"]) for i in range(0, 70, 3)]
    out = [e for b in module._joined_up(batches) for e in zip(*(c.to_pylist() for c in b.columns), strict=True)]

    def least(pairs):
        at = list(range(60))
        for _ in range(60):
            for a, b in pairs:
                at[a] = at[b] = min(at[a], at[b])
        return at

    assert least(out) == least(edges) and len(out) <= len(edges)
