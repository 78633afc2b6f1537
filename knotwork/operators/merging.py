"""Merging two concept graphs: candidates by name, scores by tight edges, one-to-one matches, renames and field-wise merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.runtime import staged

#: Edges nearer than this are tight.
TIGHT = 45


def name_variants(key: Column, common_name: Column, aliases: Column) -> Column:
    """Lower-case names of a concept: the key up to its parentheses, the common name and the aliases but for 'Wikipedia:' ones."""
    base = F.lower(F.when(F.instr(key, "(") > 1, F.rtrim(F.substring_index(key, "(", 1))).otherwise(key))
    names = F.filter(F.transform(aliases, lambda a: a["name"]), lambda n: ~n.contains("Wikipedia:"))
    return F.array_distinct(F.array_compact(F.concat(F.array(base, F.lower(common_name)), F.transform(names, F.lower))))


def edge_key(name: Column) -> Column:
    """Edge names are compared without ' (…)' and without case."""
    return F.lower(F.regexp_replace(name, "\\s\\(.+\\)", ""))


def match_scores(base: DataFrame, add: DataFrame) -> DataFrame:
    """(b, a, score): pairs that share a name variant, with their number of common tight edges (more than 0).

    An edge is common when either distance is missing or either is tight. Variant and edge are joined together, so names
    that very many concepts share never pair concepts without a common edge.
    """

    def flat(df: DataFrame, id_: str, d: str) -> DataFrame:
        one = df.select(F.col("key").alias(id_), F.explode(name_variants(F.col("key"), F.col("common_name"), F.col("aliases"))).alias("variant"), "edges")
        return one.select(id_, "variant", F.posexplode("edges").alias(f"{id_}_n", "e")).select(id_, "variant", f"{id_}_n", edge_key(F.col("e.name")).alias("edge"), F.col("e.distance").alias(d))

    both = flat(base, "b", "db").join(flat(add, "a", "da"), ["variant", "edge"])
    tight = both.filter(F.col("db").isNull() | F.col("da").isNull() | (F.col("db") < TIGHT) | (F.col("da") < TIGHT))
    return tight.select("b", "a", "b_n", "a_n").distinct().groupBy("b", "a").agg(F.count("*").alias("score"))


def match_one_to_one(scores: DataFrame) -> DataFrame:
    """Greedy one-to-one matches of (b, a, score) by falling score, then b and a.

    Rounds take every pair that is the best of both its sides; for a total order that gives the matches of the
    sequential greedy choice.
    """
    left, done = staged(scores), None
    while True:
        order = (F.desc("score"), F.asc("b"), F.asc("a"))
        ranked = left.withColumn("rb", F.row_number().over(Window.partitionBy("b").orderBy(*order))).withColumn("ra", F.row_number().over(Window.partitionBy("a").orderBy(*order)))
        new = staged(ranked.filter("rb = 1 and ra = 1").select("b", "a", "score"))
        if new.isEmpty():
            return done if done is not None else new
        done = new if done is None else done.unionByName(new)
        left = staged(left.join(new.select("b"), "b", "left_anti").join(new.select("a"), "a", "left_anti"))


def rename_conflicts(base_keys: DataFrame, add_keys: DataFrame, matches: DataFrame) -> DataFrame:
    """(a, name): new names 'key (n)' of unmatched keys of the second graph that the first holds; n is free in both."""
    free = add_keys.select(F.col("key").alias("a")).join(matches.select("a"), "a", "left_anti")
    taken = free.join(base_keys.select(F.col("key").alias("a")), "a", "left_semi")
    stem = lambda c: F.regexp_replace(c, "\\s*\\(\\d+\\)$", "")
    number = lambda c: F.regexp_extract(c, "\\((\\d+)\\)$", 1).try_cast("int")
    used = base_keys.select("key").unionByName(add_keys.select("key")).select(stem(F.col("key")).alias("stem"), number(F.col("key")).alias("n")).filter("n is not null")
    conflict = taken.select("a", stem(F.col("a")).alias("stem"))
    used = used.join(conflict.select("stem").distinct(), "stem", "left_semi").groupBy("stem").agg(F.collect_set("n").alias("used"))
    ranked = conflict.withColumn("k", F.row_number().over(Window.partitionBy("stem").orderBy("a"))).join(used, "stem", "left").withColumn("used", F.coalesce("used", F.array().cast("array<int>")))
    numbers = F.filter(F.sequence(F.lit(1), F.size("used") + F.col("k")), lambda n: ~F.array_contains(F.col("used"), n))
    return ranked.select("a", F.concat(F.col("stem"), F.lit(" ("), numbers[F.col("k") - 1].cast("string"), F.lit(")")).alias("name"))


def _latest_maps(first: Column, second: Column) -> Column:
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    a, b = F.coalesce(first, empty), F.coalesce(second, empty)
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def merge_graphs(base: DataFrame, add: DataFrame, matches: DataFrame, renames: DataFrame) -> DataFrame:
    """The merged concepts (key, common_name, aliases, edges, descriptions, web_sites, nomenclature, last_updates, entity).

    Keys of the second graph become those of their match, or their new name, in keys and in edge names. Of matched
    concepts the first graph's name, entity and equal aliases win, the second's web sites, nomenclature and updates;
    descriptions are united; edges have the smaller distance and the descriptors of both, those of the second without a
    source address that the first has. All else is taken over.
    """
    names = matches.select("a", F.col("b").alias("to")).unionByName(renames.select("a", F.col("name").alias("to")))
    fields = ["common_name", "aliases", "edges", "descriptions", "web_sites", "nomenclature", "last_updates", "entity"]
    flat = add.select("key", F.posexplode("edges").alias("i", "e")).select("key", "i", "e", F.col("e.name").alias("en"))
    told = flat.join(names, flat["en"] == names["a"], "left").select("key", F.struct("i", F.struct(F.coalesce("to", "en").alias("name"), F.col("e.distance").alias("distance"), F.col("e.descriptors").alias("descriptors")).alias("e")).alias("x"))
    edges = told.groupBy(F.col("key").alias("k2")).agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["e"]).alias("new_edges"))
    moved = add.join(edges, add["key"] == edges["k2"], "left").withColumn("edges", F.coalesce("new_edges", F.filter("edges", lambda _: F.lit(False)))).join(names, add["key"] == names["a"], "left")
    moved = moved.select(F.coalesce("to", "key").alias("key"), *fields)
    both = base.select("key", F.lit(True).alias("hb"), *(F.col(f).alias(f"b_{f}") for f in fields)).join(moved.select("key", F.lit(True).alias("ha"), *(F.col(f).alias(f"a_{f}") for f in fields)), "key", "full_outer")
    none = lambda c: F.filter(c, lambda _: F.lit(False))
    list_of = lambda f, p: F.coalesce(F.col(f"{p}_{f}"), none(F.coalesce(f"b_{f}", f"a_{f}")))
    ba, aa = list_of("aliases", "b"), list_of("aliases", "a")
    aliases = F.concat(ba, F.filter(aa, lambda x: ~F.exists(ba, lambda y: y["name"] == x["name"])))
    be, ae = list_of("edges", "b"), list_of("edges", "a")

    def with_other(e):
        twin = F.get(F.filter(ae, lambda x: x["name"] == e["name"]), F.lit(0))
        more = F.filter(F.coalesce(twin["descriptors"], none(e["descriptors"])), lambda d: d["source_URL"].isNull() | ~F.exists(e["descriptors"], lambda o: o["source_URL"] == d["source_URL"]))
        return F.struct(e["name"].alias("name"), F.when(e["distance"].isNull() | twin["distance"].isNull(), F.coalesce(e["distance"], twin["distance"])).otherwise(F.least(e["distance"], twin["distance"])).alias("distance"), F.concat(e["descriptors"], more).alias("descriptors"))

    edges_ = F.concat(F.transform(be, lambda e: with_other(e)), F.filter(ae, lambda x: ~F.exists(be, lambda y: y["name"] == x["name"])))
    return both.select(
        "key",
        F.coalesce("b_common_name", "a_common_name").alias("common_name"),
        aliases.alias("aliases"),
        edges_.alias("edges"),
        F.array_distinct(F.concat(list_of("descriptions", "b"), list_of("descriptions", "a"))).alias("descriptions"),
        *(_latest_maps(F.col(f"b_{f}"), F.col(f"a_{f}")).alias(f) for f in ("web_sites", "nomenclature", "last_updates")),
        F.coalesce("b_entity", "a_entity").alias("entity"),
    )
