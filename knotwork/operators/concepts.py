"""Operators on concept documents as typed rows (see ``sources.concepts``): dictionaries, canonical names, merged relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.operators.graph import LOOP

#: Distance of relations that no table holds, and relations to be looked up have a distance below this.
UNKNOWN_DISTANCE, LOOKED_UP_BELOW = 255, 0


def serialized(pairs):
    """An array of structs (d, name) as 'name|d|name|d'."""
    return F.array_join(F.transform(pairs, lambda x: F.concat_ws("|", x["name"], x["d"].cast("string"))), "|")


def alias_to_canonicals(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(alias, canonicals): the concepts of every name and alias, 'c|d|c|d' by distance; of a concept named twice the nearest counts.

    The common name (the key where it is missing) stands at distance 0.
    """
    own = concepts.select(F.coalesce("common_name", key).alias("alias"), F.col(key).alias("name"), F.lit(0).alias("d"))
    other = concepts.select(F.col(key).alias("name"), F.explode("aliases").alias("a")).select(F.col("a.name").alias("alias"), "name", F.col("a.distance").alias("d"))
    near = own.unionByName(other).groupBy("alias", "name").agg(F.min("d").alias("d"))
    return near.groupBy("alias").agg(F.sort_array(F.collect_list(F.struct("d", "name"))).alias("p")).select("alias", serialized("p").alias("canonicals"))


def default_aliases(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(key, alias): every alias with its lower case, and the lower case of key and common name where it differs."""
    lower = lambda c: F.when(F.lower(c) != c, F.lower(c))
    names = F.transform("aliases", lambda a: a["name"])
    all_ = F.concat(F.array(lower(F.col(key)), lower(F.col("common_name"))), names, F.transform(names, F.lower))
    return concepts.select(F.col(key).alias("key"), F.explode(F.array_distinct(F.array_compact(all_))).alias("alias")).distinct()


def concept_dict(concepts: DataFrame, sourced: str, key: str = "concept_key") -> DataFrame:
    """(name, keys): concepts with an update of ``sourced`` or a stated entity, by common name, home page, blog and aliases."""
    kept = concepts.filter(F.col("last_updates")[sourced].isNotNull() | F.col("entity").isNotNull())
    names = F.concat(F.array("common_name", F.col("web_sites")["home_page"], F.col("web_sites")["blog"]), F.transform("aliases", lambda a: a["name"]))
    flat = kept.select(F.col(key).alias("k"), F.explode(F.array_compact(names)).alias("name")).distinct()
    return flat.groupBy("name").agg(F.array_join(F.sort_array(F.collect_list("k")), "|").alias("keys"))


def identifications(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(key, kind, value) of web sites and nomenclature; of one kind the nomenclature wins."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    sites = F.map_filter(F.coalesce("web_sites", empty), lambda k, _: ~F.map_contains_key(F.coalesce(F.col("nomenclature"), empty), k))
    return concepts.select(F.col(key).alias("key"), F.explode(F.map_concat(sites, F.coalesce("nomenclature", empty))).alias("kind", "value"))


def concept_urls(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(key, common_name, home_page, aliases): aliases that start with a capital, sorted and joined."""
    capital = F.filter(F.transform("aliases", lambda a: a["name"]), lambda n: n.rlike("^[A-Z]"))
    return concepts.select(F.col(key).alias("key"), "common_name", F.col("web_sites")["home_page"].alias("home_page"), F.array_join(F.array_sort(F.array_distinct(capital)), "|").alias("aliases"))


def relations_of(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(src, dst, category, subcategory, snippet, url, distance, edge_distance): one row for each descriptor of each edge."""
    edges = concepts.select(F.col(key).alias("src"), F.explode("edges").alias("e")).select("src", F.col("e.name").alias("dst"), F.col("e.distance").alias("edge_distance"), F.explode("e.descriptors").alias("d"))
    return edges.select("src", "dst", F.col("d.relationship_category").alias("category"), F.col("d.relationship_subcategory").alias("subcategory"), F.col("d.snippet").alias("snippet"), F.col("d.source_URL").alias("url"), F.col("d.distance").alias("distance"), "edge_distance")


def snippet_table(relations: DataFrame) -> DataFrame:
    """(key, snippet): relations with a snippet under 'a|b|category|subcategory'."""
    return relations.filter("snippet is not null").select(F.concat_ws("|", "src", "dst", F.coalesce("category", F.lit("")), F.coalesce("subcategory", F.lit(""))).alias("key"), "snippet")


def concept_neighbors(concepts: DataFrame, key: str = "concept_key") -> DataFrame:
    """(key, neighbors): names of edges as 'n|d|n|d' by distance; the concept itself and edges without a distance are left out."""
    flat = concepts.select(F.col(key).alias("key"), F.explode("edges").alias("e")).select("key", F.col("e.name").alias("name"), F.col("e.distance").alias("d")).filter("d is not null and name <> key")
    near = flat.groupBy("key", "name").agg(F.min("d").alias("d"))
    return near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("d", "name"))).alias("p")).select("key", serialized("p").alias("neighbors"))


def canonicalize(relations: DataFrame, aliases: DataFrame, *columns: str) -> DataFrame:
    """Relations with canonical names in ``columns`` by ``aliases`` (alias, target); names whose target is a loop are dropped, unknown names kept."""
    out = relations
    for c in columns:
        names = aliases.select(F.col("alias").alias("_a"), F.col("target").alias("_t"))
        out = out.join(names, out[c] == names["_a"], "left").withColumn(c, F.coalesce("_t", c)).drop("_a", "_t").filter(F.col(c) != LOOP)
    return out


def fill_distances(relations: DataFrame, distances: DataFrame) -> DataFrame:
    """Relations with distances below 0 looked up in ``distances`` (src, dst, distance), 255 where it has none; edge_distance is the least of an edge."""
    known = distances.select("src", "dst", F.col("distance").alias("_d"))
    filled = relations.join(known, ["src", "dst"], "left").withColumn("distance", F.when(F.col("distance") < LOOKED_UP_BELOW, F.coalesce("_d", F.lit(UNKNOWN_DISTANCE))).otherwise(F.col("distance"))).drop("_d")
    least = filled.groupBy("src", "dst").agg(F.min("distance").alias("edge_distance"))
    return filled.drop("edge_distance").join(least, ["src", "dst"])


def merge_relations(relations: DataFrame) -> DataFrame:
    """(src, dst, category, subcategory, distance, snippet, edge_distance): one relation for each pair and category.

    The smallest distance wins, then the shorter snippet, then its order as text; UNCLASSIFIED relations take the shortest
    snippet whatever its distance. edge_distance is the least of the pair. Relations to the concept itself are left out.
    """
    named = relations.filter(F.col("src") != F.col("dst"))
    order = F.struct(F.coalesce("distance", F.lit(2**31 - 1)), F.coalesce(F.length("snippet"), F.lit(2**31 - 1)), F.coalesce("snippet", F.lit("")))
    shortest = F.min(F.when(F.col("snippet").isNotNull(), F.struct(F.length("snippet").alias("n"), F.col("snippet").alias("s"))))
    per = named.groupBy("src", "dst", F.coalesce("category", F.lit("UNCLASSIFIED")).alias("category"), F.coalesce("subcategory", F.lit("UNCLASSIFIED")).alias("subcategory")).agg(
        F.min("distance").alias("distance"), F.min_by("snippet", order).alias("best"), shortest.alias("short")
    )
    per = per.withColumn("snippet", F.when(F.col("category") == "UNCLASSIFIED", F.col("short.s")).otherwise(F.col("best"))).drop("best", "short")
    least = per.groupBy("src", "dst").agg(F.min("distance").alias("edge_distance"))
    return per.join(least, ["src", "dst"])


def merge_aliases(aliases: DataFrame) -> DataFrame:
    """(src, alias, distance): the nearest of repeated aliases; capitalised ones also in lower case where that is not given."""
    from knotwork.functions.titles import lower_alias

    near = aliases.groupBy("src", "alias").agg(F.min("distance").alias("distance"))
    twins = near.select("src", lower_alias(F.col("alias")).alias("alias"), "distance").filter("alias is not null").groupBy("src", "alias").agg(F.min("distance").alias("distance"))
    return near.unionByName(twins.join(near.select("src", "alias"), ["src", "alias"], "left_anti"))


def kv_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, left, right, status) of two key-value tables: identical but for case, changed, only_left or only_right."""
    l, r = left.select("key", F.col("value").alias("left"), F.lit(True).alias("_l")), right.select("key", F.col("value").alias("right"), F.lit(True).alias("_r"))
    both = l.join(r, "key", "full_outer")
    same = F.lower("left").eqNullSafe(F.lower("right"))
    return both.select("key", "left", "right", F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").when(same, "identical").otherwise("changed").alias("status"))


# First parts of relations that are no facts about a thing.
BLOCKED_DOMAINS = ("freebase", "pipeline", "type", "dataworld", "common", "user", "community")


def freebase_names(triples: DataFrame, language: str = "/lang/en") -> DataFrame:
    """(id, name, key) folded from rows (id, kind 'name' or 'key', a, b, seq).

    Names: a is the language, b the name; ``language`` wins, then the first by seq. Keys: a is the name space, b 'best' or
    the key; 'best' wins. key is 'name (key)', without the key's last word where it repeats the name.
    """
    clean = F.regexp_replace(F.regexp_replace("b", "\\s+\\(.*\\)", ""), " \\s+", " ")
    space = F.replace(F.regexp_replace("a", "^/[^/]*/", ""), F.lit("/"), F.lit(" "))
    names = triples.filter("kind = 'name'").groupBy("id").agg(F.min_by(clean, F.struct(F.col("a") != language, "seq")).alias("name"))
    keys = triples.filter("kind = 'key'").groupBy("id").agg(F.min_by(F.when(F.col("b") == "best", space).otherwise(F.concat_ws(" ", space, "b")), F.struct(F.col("b") != "best", "seq")).alias("k"))
    both = names.join(keys, "id", "full_outer")
    cut = F.when((F.instr("k", " ") > 1) & (F.substring_index("k", " ", -1) == F.col("name")), F.regexp_replace("k", " [^ ]*$", "")).otherwise(F.coalesce("k", "name"))
    return both.select("id", "name", F.when(F.col("name").isNotNull(), F.concat(F.col("name"), F.lit(" ("), cut, F.lit(")"))).otherwise(F.col("k")).alias("key"))


def relation_filter(triples: DataFrame, blocked: tuple[str, ...] = BLOCKED_DOMAINS) -> DataFrame:
    """Triples (s, p, o) that state something: no reverse, master or id relations, blocked domains, booleans, addresses, or numbers other than years."""
    p, o = F.col("p"), F.col("o")
    number, year = o.rlike("^-?[\\d.]+([eE]-?\\d+)?$"), o.rlike("^\\d{4}$")
    last = F.substring_index(p, "/", -1)
    dated = last.contains("year") | last.contains("date") | last.contains("introduced") | last.contains("founded") | last.contains("closed")
    return triples.filter(~p.rlike("^reverse_of:|^master:|[_/u]id$") & ~F.coalesce(F.try_element_at(F.split(p, "/"), F.lit(2)).isin(*blocked), F.lit(False)) & ~o.isin("true", "false") & ~o.rlike("^https?:") & (~number | (year & dated)))


def relation_samples(triples: DataFrame, n: int = 3) -> DataFrame:
    """(p, n, samples): number of triples of each relation and its first ``n`` as text."""
    said = F.concat(F.lit('"'), F.concat_ws(" ", "s", "p", "o"), F.lit('"'))
    # only the n smallest of each group are ever held: they are ranked within the group by a window limit
    from pyspark.sql import Window

    counts = triples.groupBy("p").agg(F.count("*").alias("n"))
    first = triples.select("p", said.alias("t")).withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("t"))).filter(F.col("r") <= n)
    return counts.join(first.groupBy("p").agg(F.array_join(F.sort_array(F.collect_list("t")), ", ").alias("samples")), "p").select("p", "n", F.concat(F.lit("("), "samples", F.lit(")")).alias("samples"))
