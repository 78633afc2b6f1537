"""Links, pairs, paths, redirects, merge and resolution on small graphs."""

from __future__ import annotations

import itertools
import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from knotwork.operators import concepts, graph, links, merging, pairs, resolving
from knotwork.plans import catalog_graph, catalog_links
from knotwork.runtime import hot_keys, lookup_join, staged


def test_pair_store(spark):
    store = pairs.upsert_pairs(spark.createDataFrame([], "lo int, hi int, distance int"), spark.createDataFrame([(1, 1, 2, 127), (2, 3, 4, 64), (3, 1, 5, 32), (4, 5, 3, 50), (5, 7, 7, 1)], "seq int, a int, b int, distance int"))
    assert rows(store) == [(1, 2, 127), (1, 5, 32), (3, 4, 64), (3, 5, 50)]
    assert rows(pairs.pair_lookup(store, spark.createDataFrame([(3, 1), (4, 3)], "a int, b int")), "distance") == [(255,), (64,)]
    close = [r["other"] for r in pairs.close_sites(store).filter("id = 1").collect()]
    assert sorted(close) == [2, 5]
    ids = spark.createDataFrame([(1, 3), (1, 1), (1, 5), (2, 2), (2, 1), (2, 5), (2, 3), (2, 3)], "batch int, id int")
    got = pairs.pair_distances(store, ids)
    assert rows(got.filter("batch = 1"), "a", "b") == [(1, 5), (3, 5)] and got.filter("batch = 2").count() == 3
    gone = pairs.upsert_pairs(store, spark.createDataFrame([(1, 2, 1, None), (2, 4, 3, 10), (1, 4, 3, 20)], "seq int, a int, b int, distance int"))
    assert rows(gone) == [(1, 5, 32), (3, 4, 10), (3, 5, 50)]


def test_site_distance_is_symmetric_and_bounded(spark):
    random.seed(5)
    sets = {s: {random.randrange(20) + 100 for _ in range(random.randrange(1, 6))} | {s} for s in range(12)}
    df = spark.createDataFrame([(s, x) for s, v in sets.items() for x in v if x != s] + [(3, None), (None, 4)], "site int, linker int")
    expected = {}
    for x, y in itertools.combinations(sets, 2):
        b = len(sets[x] & sets[y])
        if b and (d := max(1, 256 - 128 * b // len(sets[x]) - 128 * b // len(sets[y]))) <= 249:
            expected[x, y] = d
    assert {(r["lo"], r["hi"]): r["distance"] for r in pairs.site_distances(df).collect()} == expected


def test_edge_distance_range(spark):
    random.seed(2)
    lk = {(random.randrange(15), random.randrange(15)) for _ in range(70)}
    df = spark.createDataFrame([(a, b, 1, True) for a, b in lk if a != b], "src int, dst int, count int, in_text boolean")
    got = links.edge_distances(df).collect()
    assert got and all(10 <= r["distance"] <= 64 for r in got)
    assert rows(links.self_relations(df)) == []
    names = links.canonical_outlinks(spark.createDataFrame([("p", 2, "b"), ("p", 1, "A"), ("p", 3, "a"), ("p", 4, "z"), ("p", 5, "l")], "src string, pos int, target string"), spark.createDataFrame([("A", "a"), ("l", "|")], "alias string, canonical string"))
    assert rows(names) == [("p", "a|b|z")]


def bellman(edges, seeds, hops):
    best = dict(seeds)
    for _ in range(hops):
        new = dict(best)
        for a, b, w in edges:
            if a in best and best[a] + w < new.get(b, 10**9):
                new[b] = best[a] + w
        best = new
    return best


@pytest.mark.parametrize("seed", range(3))
def test_shortest_chain_against_bellman_ford(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(25), random.randrange(25), random.randrange(0, 30)) for _ in range(70)]
    asked, expected = [], {}
    for q in range(12):
        a, b, c = (random.randrange(25) for _ in range(3))
        asked += [(q, "a", a, 0), (q, "a", c, 1), (q, "b", b, 0), (q, "b", None, 1), (q, "b", 77, 2)]
        for_a, for_b = bellman(edges, {c: 10, a: 0} if a != c else {a: 0}, 2), bellman(edges, {b: 0}, 2)
        both = [for_a[x] + for_b[x] for x in for_a.keys() & for_b.keys()]
        if both:
            expected[q] = min(both)
    e = spark.createDataFrame(edges, "src int, dst int, weight int")
    nodes = spark.createDataFrame([(i, i) for i in range(25)], "alias int, node int")
    got = graph.shortest_chains(e, spark.createDataFrame(asked, "query int, side string, alias int, pos int"), nodes, max_links=1, increasing=True).collect()
    assert {r["query"]: r["dist"] for r in got} == expected
    told = {r["query"]: r["response"] for r in graph.path_json(spark.createDataFrame(got), e.withColumn("text", F.lit("said"))).collect()}
    assert set(told) == set(expected) and all('"payload"' in t for t in told.values())


def test_chain_queries_take_all_hops(spark, data):
    edges = [tuple(r) for r in catalog_graph._edges(spark, data).select("src", "dst", "weight").collect()]
    ids = {r["id"] for r in catalog_links.pages(spark, data).collect()}
    expected = {}
    for q in (int(i[1:]) for i in ids if i[0] == "C" and int(i[1:]) % 20 == 0 and f"C{int(i[1:]) + 1}" in ids):
        for_a, for_b = bellman(edges, {f"C{q}": 0}, 7), bellman(edges, {f"C{q + 1}": 0}, 7)
        both = [for_a[x] + for_b[x] for x in for_a.keys() & for_b.keys()]
        if both:
            expected[q] = min(both)
    assert dict(rows(catalog_graph.shortest_chain(spark, data))) == expected
    told = {r["query"]: json.loads(r["response"])["payload"]["edges"] for r in catalog_graph.chain_responses(spark, data).collect()}
    assert {q: sum(e["distance"] for e in t) for q, t in told.items()} == expected


def _ask(spark, *ends):
    return spark.createDataFrame([(q, side, alias, 0) for q, a, b in ends for side, alias in (("a", a), ("b", b))], "query int, side string, alias string, pos int")


def test_chain_search_ends_with_an_end_that_has_no_links(spark, monkeypatch):
    chain = [(f"n{i}", f"n{i + 1}", 5) for i in range(9)] + [("n0", f"m{i}", 4) for i in range(5)]
    e = spark.createDataFrame(chain, "src string, dst string, weight int")
    nodes = spark.createDataFrame([(x, x) for x in sorted({x for s, d, _ in chain for x in (s, d)} | {"alone"})], "alias string, node string")
    steps = []
    monkeypatch.setattr(graph, "staged", lambda df, **o: steps.append(1) or staged(df, **o))
    assert graph.shortest_chains(e, _ask(spark, (1, "n0", "alone"), (2, "alone", "n0")), nodes).count() == 0
    assert len(steps) <= 8  # not one after the other all hops of the end that has links
    assert rows(graph.shortest_chains(e, _ask(spark, (1, "n0", "n7"), (2, "n0", "n8")), nodes), "query", "links") == [(1, 7)]


def test_first_of_equal_chains_and_limits_of_either_side(spark):
    e = [("a", "m", 1), ("z1", "m", 1), ("z2", "m", 1), ("y1", "z2", 1), ("y2", "z1", 1), ("b", "y1", 1), ("b", "y2", 1), ("p", "q", 1), ("q", "r", 1), ("r", "s", 1), ("p", "t", 9), ("s", "t", 9)]
    df = spark.createDataFrame(e, "src string, dst string, weight int")
    nodes = spark.createDataFrame([(x, x) for x in "a m z1 z2 y1 y2 b p q r s t".split()], "alias string, node string")
    got = graph.shortest_chains(df, _ask(spark, (1, "a", "b"), (2, "p", "s")), nodes, max_links=2)
    assert rows(got, "query", "dist", "path") == [(1, 4, ["a", "m", "z1", "y2", "b"]), (2, 3, ["p", "q", "r", "s"])]
    # p reaches s in three links, which a limit of two a side leaves out
    assert rows(graph.shortest_chains(df, _ask(spark, (2, "p", "s")), nodes, max_links=1), "dist", "path") == [(18, ["p", "t", "s"])]


def test_page_chain_avoids_popular_pages(spark):
    df = spark.createDataFrame([("a", "hub"), ("hub", "b"), ("x", "hub"), ("y", "hub"), ("a", "m"), ("m", "n"), ("n", "b")], "src string, dst string")
    got = graph.page_chains(df, spark.createDataFrame([(1, "a", "b"), (2, "a", "nowhere"), (3, None, "b")], "query int, a string, b string"))
    assert rows(got, "query", "dist", "path") == [(1, 4, ["a", "m", "n", "b"])]
    assert graph.topic_pairs(["x", "y", "x"]) == [("x", "y"), ("y", "x")]


def test_redirects(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(14)] + [("x", "y"), ("y", "z"), ("z", "y"), ("s", "s"), (None, "a"), ("n", None), ("d", "c12"), ("d", "zz")]
    r = spark.createDataFrame(chain, "alias string, target string")
    got = {x["alias"]: (x["target"], x["steps"]) for x in graph.ultimate_redirects(r).collect()}
    assert got["c0"] == ("c14", 14) and got["x"] == got["y"] == got["s"] == ("|", None) and got["d"] == ("c14", 3)
    short = dict(rows(graph.resolved_redirects(r, spark.createDataFrame([("c14",)], "id string"))))
    assert "c4" in short and "c3" not in short and "x" not in short
    again = graph.ultimate_redirects(graph.ultimate_redirects(r).filter("steps is not null").select("alias", "target"))
    assert {x["alias"]: x["target"] for x in again.collect()} == {a: t for a, (t, s) in got.items() if s}
    assert rows(graph.ultimate_redirects(r.limit(0))) == []


def test_drill_down_with_loops(spark):
    c = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "a"), ("b", "r")], "parent string, child string")
    p = spark.createDataFrame([("b", 1), ("a", 1), ("r", 2), ("o", 3)], "category string, page int")
    assert rows(graph.drill_down(c, p, spark.createDataFrame([("r",), ("o",)], "category string"))) == [("o", 3), ("r", 1), ("r", 2)]


def test_asked_distances_build_only_what_is_asked(spark, data):
    random.seed(5)
    linkers = spark.createDataFrame([(random.choice("abcdefgh"), random.randrange(12)) for _ in range(60)] + [("a", None), (None, 1), ("z", 99)], "site string, linker int").select("site", F.col("linker").cast("string").alias("linker"))
    asked = spark.createDataFrame([(x, y) for x in "abcdz" for y in "abcdefghz?"] + [(None, "a")], "a string, b string")
    store = {(x, y): n for x, y, n in rows(pairs.site_distances(linkers))}
    want = {(min(x, y), max(x, y)): store.get((min(x, y), max(x, y))) for x in "abcdz" for y in "abcdefghz" if x != y}
    assert {(x, y): n for x, y, n in rows(pairs.asked_distances(linkers, asked))} == {k: n for k, n in want.items() if n is not None}
    plan = catalog_links.pair_lookup(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "lo#" in plan and not [x for x in plan.split("\n") if "Join" in x and re.search(r"\(lo#\d+ < (hi|lo)#\d+\)", x)]  # no pairs of all sites of a linker


def test_greedy_matching(spark):
    random.seed(1)
    scores = list({(b, a): (b, a, random.randrange(1, 6)) for b, a in ((random.randrange(12), random.randrange(12)) for _ in range(60))}.values())
    used_b, used_a, expected = set(), set(), []
    for b, a, s in sorted(scores, key=lambda x: (-x[2], x[0], x[1])):
        if b not in used_b and a not in used_a:
            used_b.add(b), used_a.add(a), expected.append((b, a, s))
    assert rows(merging.match_one_to_one(spark.createDataFrame(scores, "b int, a int, score int"))) == sorted(expected, key=str)
    assert rows(merging.match_one_to_one(spark.createDataFrame([], "b int, a int, score int"))) == []


CONCEPT = "key string, common_name string, aliases array<struct<name:string,distance:int>>, edges array<struct<name:string,distance:int,descriptors array<struct<source_URL:string>>>>, descriptions array<string>, web_sites map<string,string>, nomenclature map<string,string>, last_updates map<string,string>, entity string".replace("descriptors array", "descriptors:array")


def test_merge(spark):
    base = spark.createDataFrame([("Mill", "Mill", [("mill", 0)], [("River (big)", 50, [("u",)]), ("Town", None, [])], ["old"], {"home_page": "h1"}, None, {"x": "1"}, "nonperson"), ("Oak", "Oak", [], [], [], None, None, None, None), ("Oak (1)", None, [], [], [], None, None, None, None)], CONCEPT)
    add = spark.createDataFrame([("The Mill", "mill", [("Mill", 3)], [("river", 20, [("u",), ("v",)]), ("The Mill", 1, [])], ["new"], {"home_page": "h2"}, {"f": "m"}, {"y": "2"}, "person"), ("Oak", "Other oak", [], [("Town", 9, [])], [], None, None, None, None)], CONCEPT)
    scores = merging.match_scores(base, add)
    assert rows(scores) == [("Mill", "The Mill", 1)]
    matches = merging.match_one_to_one(scores)
    renames = merging.rename_conflicts(base, add, matches)
    assert rows(renames) == [("Oak", "Oak (2)")]
    merged = {r["key"]: r for r in merging.merge_graphs(base, add, matches, renames).collect()}
    assert set(merged) == {"Mill", "Oak", "Oak (1)", "Oak (2)"}
    m = merged["Mill"]
    assert m["common_name"] == "Mill" and m["entity"] == "nonperson" and m["web_sites"] == {"home_page": "h2"} and m["last_updates"] == {"x": "1", "y": "2"}
    assert [e["name"] for e in m["edges"]] == ["River (big)", "Town", "river", "Mill"] and m["descriptions"] == ["old", "new"]


def test_kv_diff_and_relations(spark):
    l, r = spark.createDataFrame([("a", "X"), ("b", "1"), ("c", None)], "key string, value string"), spark.createDataFrame([("a", "x"), ("b", "2"), ("d", "3")], "key string, value string")
    assert rows(concepts.kv_diff(l, r), "key", "status") == [("a", "identical"), ("b", "changed"), ("c", "only_left"), ("d", "only_right")]
    rel = spark.createDataFrame([("a", "b", "UNCLASSIFIED", "s", "long one", 5), ("a", "b", "UNCLASSIFIED", "s", "short", 9), ("a", "b", "X", "s", "far", 7), ("a", "b", "X", "s", "near", 2), ("a", "a", "X", "s", "self", 1), ("a", "b", None, None, None, None)], "src string, dst string, category string, subcategory string, snippet string, distance int")
    got = {(x["category"], x["subcategory"]): (x["distance"], x["snippet"], x["edge_distance"]) for x in concepts.merge_relations(rel).collect()}
    assert got == {("UNCLASSIFIED", "s"): (5, "short", 2), ("X", "s"): (2, "near", 2), ("UNCLASSIFIED", "UNCLASSIFIED"): (None, None, 2)}
    assert rows(concepts.merge_aliases(spark.createDataFrame([("a", "Big Mill", 3), ("a", "Big Mill", 1), ("a", "IBM", 2)], "src string, alias string, distance int"))) == [("a", "Big Mill", 1), ("a", "IBM", 2), ("a", "big mill", 1)]


def test_resolution(spark):
    requests = spark.createDataFrame([(1, "apple"), (1, "mac"), (1, "apple"), (2, "apple"), (3, "unknown")], "request int, text string")
    aliases = spark.createDataFrame([("apple", "Apple Inc", 5), ("apple", "Apple fruit", 0), ("mac", "Macintosh", 0)], "alias string, canonical string, quality int")
    near = spark.createDataFrame([("Apple Inc", "Macintosh", 10), ("Macintosh", "Apple Inc", 10), ("Apple Inc", "Apple fruit", 1)], "canonical string, neighbor string, quality int")
    assert rows(resolving.resolve_concepts(requests, aliases, near)) == [(1, "apple", "Apple Inc", 185), (1, "mac", "Macintosh", 190)]


def test_meanings_of_one_text_are_not_paired(spark):
    meanings = [("many", f"m{i}", i % 40) for i in range(60)] + [("one", "m7", 3), ("one", "x", 0)]
    requests = spark.createDataFrame([(1, "many"), (1, "one"), (2, "many")], "request int, text string")
    near = spark.createDataFrame([("m1", "m2", 5), ("m3", "x", 5), ("x", "m3", 5), ("m7", "m3", 1)], "canonical string, neighbor string, quality int")
    got = resolving.resolve_concepts(requests, spark.createDataFrame(meanings, "alias string, canonical string, quality int"), near)
    assert rows(got) == [(1, "many", "m3", 192), (1, "one", "x", 195)]
    pairs_of_text = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x and re.search(r"\(text#\d+ = text#\d+\)", x)]
    assert not pairs_of_text


def test_skew_safe_join(spark):
    left = spark.createDataFrame([(1, i) for i in range(300)] + [(2, 0), (None, 1)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "rk int, w string")
    hot, _ = hot_keys(left, F.col("k"), 50)
    assert [tuple(r) for r in hot.collect()] == [(1, 6)]
    import knotwork.runtime as R

    old, R.BROADCAST_BYTES = R.BROADCAST_BYTES, -1
    try:
        got = lookup_join(left, right, "k", "rk", "left", hot_rows=50)
    finally:
        R.BROADCAST_BYTES = old
    assert got.count() == 302 and got.filter("w = 'a'").count() == 300 and got.filter("w is null").count() == 1
