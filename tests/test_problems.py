"""Core problem operators on small tables with all that can go wrong."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from knotwork.functions.titles import title_key
from knotwork.operators import hierarchy, keycounts, orphans, shredding


def at(day: int):
    return datetime(2010, 1, day)


# --- orphan references


def orphan(spark, refs, parents, **options):
    r = spark.createDataFrame(refs, "id long, ref string, seen timestamp, block int, code string")
    p = spark.createDataFrame(parents, "title string, born timestamp, gone timestamp, key int")
    found = orphans.find_orphans(orphans.keyed(r, F.col("id"), title_key(F.col("ref")), F.col("seen")), orphans.parent_keys(p, title_key(F.col("title")), F.col("born"), F.col("gone")), **options)
    return {r["ref_id"]: r["reason"] for r in found.collect()}


PARENTS = [("Mill", at(5), None, 1), ("Mill", at(5), None, 1), ("Old bridge", at(1), at(10), 2), ("Twice", at(20), None, 3), ("twice", at(1), at(2), 3), (None, at(1), None, 4), ("Always", None, None, 5)]
REFS = [
    (1, "mill", at(6), 0, "x"), (2, "Mill", at(4), 0, "x"), (3, "_Old  bridge #part", at(9), 0, "x"), (4, "Old_bridge", at(10), 0, "x"), (5, "MILL", at(6), 0, "x"), (6, None, at(6), 0, "x"), (7, " #top", at(6), 0, "x"),
    (8, "Mill", None, 0, "x"), (9, "Gone", None, 0, "x"), (10, "Twice", at(5), 0, "x"), (11, "Always", at(1), 0, "x"), (1, "mill", at(6), 0, "x"), (12, "x" * 100_000, at(6), 0, "x"), (None, "Mill", at(1), 0, "x"),
]
EXPECTED = {2: "late", 4: "deleted", 5: "missing", 9: "missing", 10: "late", 12: "missing"}


@pytest.mark.parametrize("options", [{}, {"range_parents": 1, "block_rows": 2}])
def test_orphans(spark, options):
    assert orphan(spark, REFS, PARENTS, **options) == EXPECTED


def test_orphans_of_empty_tables(spark):
    assert orphan(spark, [], PARENTS) == {}
    assert set(orphan(spark, REFS[:2], []).values()) == {"missing"}
    assert orphan(spark, [], []) == {}


def test_hot_references_are_split(spark):
    refs = [(i, "Mill", at(4), 0, "x") for i in range(500)] + [(1000, "Always", at(4), 0, "x")]
    r = spark.createDataFrame(refs, "id long, ref string, seen timestamp, block int, code string")
    keyed = orphans.keyed(r, F.col("id"), title_key(F.col("ref")), F.col("seen"))
    routed, ranges = orphans._prepare(keyed, orphans.parent_keys(spark.createDataFrame(PARENTS, "title string, born timestamp, gone timestamp, key int"), title_key(F.col("title"))), None, 2, 50)
    assert routed.groupBy("block").count().agg(F.max("count")).first()[0] < 150
    assert ranges.groupBy("block").count().agg(F.max("count")).first()[0] == 1
    assert len(orphan(spark, refs, PARENTS, block_rows=50)) == 500


def test_orphan_report_and_resolve(spark):
    r = spark.createDataFrame([(1, 10), (2, 11), (3, None), (2, 11)], "id long, ref long")
    p = spark.createDataFrame([(10, 7), (12, 8)], "key long, other long")
    got = orphans.resolve_keys(orphans.keyed(r, F.col("id"), F.col("ref")), orphans.parent_keys(p, F.col("key"), other=F.col("other")), "other")
    assert rows(got) == [(1, 7), (2, None)]
    found = spark.createDataFrame([("a", "2010-01", "late"), ("a", "2010-01", "late")], "src string, period string, reason string")
    assert rows(orphans.orphan_report(found), "n") == [(2,)]


# --- counts per key


def test_counts(spark):
    random.seed(3)
    edges = [(i, random.choice([1, 1, 1, 2, 3, 99]), random.choice([1, 4, None])) for i in range(400)]
    df = spark.createDataFrame(edges + edges[:20] + [(None, 1, 1)], "edge long, b long, e long")
    words = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 5, None)], "page long")
    b, e = Counter(x[1] for x in edges), Counter(x[2] for x in edges)
    for options in ({}, {"block_keys": 1, "split_keys": 1}):
        got = keycounts.count_keys(df, "edge", ["b", "e"], words, "page", **options)
        assert rows(got) == sorted([(k, "b", b[k]) for k in range(1, 6)] + [(k, "e", e[k]) for k in range(1, 6)], key=str)


def test_counts_through_lanes(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    df, words = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k")), spark.range(8).withColumnRenamed("id", "page")
    try:
        keycounts.LANE_SPLITS, before = 2, keycounts.LANE_SPLITS
        got = dict((r["key"], r["n"]) for r in keycounts.count_keys(df, "id", ["k"], words, "page").collect())
    finally:
        keycounts.LANE_SPLITS = before
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {k: len(range(k, 1000, 7)) for k in range(7)} | {7: 0}


def test_counts_of_empty_tables(spark):
    empty, words = spark.createDataFrame([], "edge long, b long"), spark.createDataFrame([(1,)], "page long")
    assert rows(keycounts.count_keys(empty, "edge", ["b"], words, "page")) == [(1, "b", 0)]
    assert rows(keycounts.count_keys(spark.createDataFrame([(1, 1)], "edge long, b long"), "edge", ["b"], words.limit(0), "page")) == []


# --- nested records


def brute_elements(v):
    if v is None or v == {}:
        return []
    if isinstance(v, dict) and len(v) == 1 and isinstance(v.get("items"), (list, dict)):
        return brute_elements(v["items"])
    if isinstance(v, dict) and all(k.isdigit() for k in v):
        return [(i, x) for i, x in enumerate(v.values()) if x is not None]
    if isinstance(v, list):
        return [(i, x) for i, x in enumerate(v) if x is not None]
    return [(0, v)]


def brute_edges(text):
    try:
        v = json.loads(text)
        while isinstance(v, str):
            v = json.loads(v)
    except ValueError:
        return []
    out = []
    for i, d in brute_elements(v):
        out.append(("descriptor", f"{i}"))
        s = d.get("snippet") if isinstance(d, dict) else None
        for n, x in [(0, s)] if isinstance(s, dict) and "text" in s else brute_elements(s):
            if not isinstance(x, dict) or x.get("text") is not None:
                out.append(("snippet", f"{i}/{n}"))
            if isinstance(x, dict):
                out += [("ref", f"{i}/{k}") for k, _ in brute_elements(x.get("refs"))]
    return out


def brute_docs(text):
    try:
        v = json.loads(text)
    except ValueError:
        return []
    if not isinstance(v, dict):
        return []
    out = [("alias", f"{i}") for i, _ in brute_elements(v.get("aliases"))]
    for name, e in (v.get("edges") or {}).items():
        out.append(("edge", name))
        for i, d in brute_elements(e.get("descriptors")):
            out.append(("descriptor", f"{name}/{i}"))
            if d.get("snippet") is not None:
                out.append(("snippet", f"{name}/{i}/0"))
    return out


@pytest.mark.parametrize(("name", "id_", "body", "spec", "brute"), [("graph_edges", "edge_id", "descriptors", shredding.edge_descriptors, brute_edges), ("concept_docs", "concept_row", "body", shredding.concept_bodies, brute_docs)])
def test_shredding_against_brute_force(spark, data, name, id_, body, spec, brute):
    df = spark.read.parquet(f"{data}/{name}.parquet")
    expected = sorted({(r[id_], *x) for r in df.collect() if r[body] is not None for x in brute(r[body])})
    got = shredding.shred(df, F.col(id_), F.col(body), spec)
    assert sorted((r["row_id"], r["child"], r["path"]) for r in got.collect()) == expected


BODIES = [
    (1, '[{"a": 1, "snippet": "x"}, null, {"snippet": ["p", null, "q"]}]'), (2, '{"items": [{"snippet": {"text": "t", "refs": [{"n": 1}, null, {"n": 2}]}}]}'), (3, '{"0": {"w": "1"}, "1": null, "2": {"w": 2}}'), (4, '{"w": true}'), (5, json.dumps('[{"w": 1}]')), (6, "null"), (7, "{}"), (8, "[]"), (9, "[oops"), (10, None),
    (11, '[{"snippet": null}]'), (12, ""), (13, '[{"w": NaN}]'), (1, '[{"a": 1, "snippet": "x"}, null, {"snippet": ["p", null, "q"]}]'), (None, "[{}]"), (14, "[" * 3000 + "]" * 3000), (15, json.dumps([{"w": i, "snippet": "s" * 50} for i in range(3000)])),
]


def test_shapes(spark):
    df = spark.createDataFrame(BODIES, "id long, body string").withColumn("row_id", F.lit("clash")).withColumn("path", F.lit(1))
    got = rows(shredding.shred(df, F.col("id"), F.col("body"), shredding.edge_descriptors).filter("row_id < 14"), "row_id", "child", "path")
    assert got == sorted([(1, "descriptor", "0"), (1, "snippet", "0/0"), (1, "descriptor", "2"), (1, "snippet", "2/0"), (1, "snippet", "2/2"), (2, "descriptor", "0"), (2, "snippet", "0/0"), (2, "ref", "0/0"), (2, "ref", "0/2"), (3, "descriptor", "0"), (3, "descriptor", "2"), (4, "descriptor", "0"), (5, "descriptor", "0"), (11, "descriptor", "0")], key=str)
    table = shredding.entity_table(shredding.shred(df, F.col("id"), F.col("body"), shredding.edge_descriptors), "descriptor", ["w", "a"])
    assert {r["w"] for r in table.filter("row_id in (3, 4)").collect()} == {"1", "2", "true"}
    assert table.filter("row_id = 15").count() == 3000


def test_adjacency_keeps_the_document(spark):
    df = spark.createDataFrame([(1, '{"a": [1, {"b": null}], "c": "x"}'), (1, '{"a": [1, {"b": null}], "c": "x"}')], "id long, body string")
    t = shredding.adjacency(df, F.col("id"), F.col("body")).collect()
    assert len(t) == 6 and {r["kind"] for r in t} == {"object", "array", "scalar", "null"}
    by = {r["node"]: r for r in t}

    def build(n):
        r, kids = by[n], sorted((x for x in t if x["parent"] == n), key=lambda x: x["ordinal"])
        return {k["label"]: build(k["node"]) for k in kids} if r["kind"] == "object" else [build(k["node"]) for k in kids] if r["kind"] == "array" else r["scalar"]

    assert build(0) == {"a": ["1", {"b": None}], "c": "x"}


def test_shredding_empty(spark):
    assert shredding.shred(spark.createDataFrame([], "id long, body string"), F.col("id"), F.col("body"), shredding.concept_bodies).count() == 0


# --- hierarchies


def brute_trees(links):
    parent = {}
    for n, p in links:
        if n is not None and (n not in parent or (p is not None and (parent[n] is None or p < parent[n]))):
            parent[n] = p
    out = {}
    for n in parent:
        path, cur = [n], n
        while parent[cur] is not None and parent[cur] in parent:
            cur = parent[cur]
            if cur in path:
                path = None
                break
            path.append(cur)
        out[n] = (path[-1], len(path) - 1, path) if path else (None, None, None)
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("one_in", [1, 3, 10**9])
def test_hierarchy_against_brute_force(spark, seed, one_in):
    random.seed(seed)
    links = [(i, random.choice([None, i // 2, random.randrange(60), 999])) for i in range(1, 50)] + [(100, 101), (101, 102), (102, 100), (103, 100), (104, 104), (200, 1)] + [(300 + i, 301 + i) for i in range(25)] + [(1, None), (None, 4)]
    got = hierarchy.resolve_hierarchy(spark.createDataFrame(links, "node long, parent long"), one_in=one_in)
    assert {r["node"]: (r["root"], r["depth"], r["path"]) for r in got.collect()} == brute_trees(links)


def test_hierarchy_small(spark):
    assert rows(hierarchy.resolve_hierarchy(spark.createDataFrame([], "node long, parent long"))) == []
    got = hierarchy.resolve_hierarchy(spark.createDataFrame([(1, 1), (2, None)], "node long, parent long"), with_paths=False)
    assert rows(got, "node", "root", "depth") == [(1, None, None), (2, 2, 0)]
    d = hierarchy.descendants(hierarchy.resolve_hierarchy(spark.createDataFrame([(1, None), (2, 1), (3, 2)], "node long, parent long")))
    assert rows(d) == [(1, 2, 1), (1, 3, 2), (2, 3, 1)]
