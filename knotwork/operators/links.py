"""The link graph: resolved links, mutual links, co-citation, distances, neighbours and subgraphs.

links: src, dst, count, in_text. pages: id, ambiguous, entity. All operators are joins and aggregates that Catalyst plans.
Pages in common are counted for linked pairs only, from the page of the two with fewer links to it, so a popular page or a
page of very many links never meets all pairs of its neighbours; where all pairs are asked for, the links of such a page are
salted against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.runtime import lookup_join

#: Rows of a key above which a join of links with links salts it.
HOT_LINKS = 1000
#: Largest stored count of a link.
MOST_COUNT = 255
#: Fixed values of the distance formula.
BIGGEST_INLINKS, SMALLEST_EXPONENT, BIGGEST_EXPONENT, SCALE = 293424.0, 1.0, 12.0, 50.0
NO_RELATION = 255


def resolve_links(raw: DataFrame, aliases: DataFrame) -> DataFrame:
    """Links (src, target, count, in_text) to pages by ``aliases`` (alias, canonical), self-links left out, repeats merged.

    Counts are summed up to 255, in_text is true if it once was; targets without a page are dropped.
    """
    hit = lookup_join(raw.filter("target is not null"), aliases, "target", "alias", "inner").filter(F.col("src") != F.col("canonical"))
    return hit.groupBy("src", F.col("canonical").alias("dst")).agg(F.least(F.lit(MOST_COUNT), F.sum("count")).cast("int").alias("count"), F.bool_or("in_text").alias("in_text"))


def mutual_links(links: DataFrame) -> DataFrame:
    """Links whose reverse is a link as well."""
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return links.join(back, ["src", "dst"], "left_semi")


def inlink_counts(links: DataFrame) -> DataFrame:
    """(id, inlinks) of every page with links to it."""
    return links.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("inlinks"))


def link_counts(pages: DataFrame, links: DataFrame) -> DataFrame:
    """(id, inlinks, outlinks) of every page, zeros included."""
    out = links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("outlinks"))
    return pages.select("id").join(inlink_counts(links), "id", "left").join(out, "id", "left").select("id", F.coalesce("inlinks", F.lit(0)).alias("inlinks"), F.coalesce("outlinks", F.lit(0)).alias("outlinks"))


def cocitation(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """(p, q, n): pages that link to both p and q, for the given pairs (p, q) and, as it is the same number, for (q, p); pairs without any are left out."""
    counts = inlink_counts(links)
    one = pairs.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    sized = one.join(counts.select(F.col("id").alias("p"), F.col("inlinks").alias("np")), "p").join(counts.select(F.col("id").alias("q"), F.col("inlinks").alias("nq")), "q")
    few = F.col("np") <= F.col("nq")
    rare = sized.select(F.when(few, F.col("p")).otherwise(F.col("q")).alias("x"), F.when(few, F.col("q")).otherwise(F.col("p")).alias("y"))
    through = lookup_join(rare, links.select(F.col("dst").alias("xd"), F.col("src").alias("c")), "x", "xd", "inner", HOT_LINKS)
    met = through.join(links.select(F.col("src").alias("c"), F.col("dst").alias("y")), ["c", "y"]).groupBy("x", "y").agg(F.count("*").alias("n"))
    return met.select(F.col("x").alias("p"), F.col("y").alias("q"), "n").unionByName(met.select(F.col("y").alias("p"), F.col("x").alias("q"), "n"))


def distance(n1: Column, n2: Column, common: Column, mutual: Column) -> Column:
    """The link distance of a page with n1 inlinks to one with n2, by what both are linked from; the base is kept at 0 and more."""
    one_way = (F.lit(0.97).cast("float") * (n1 + 1).cast("float") + F.lit(0.03).cast("float") * n2.cast("float")).cast("int")
    both = F.when(n1 <= n2, n1 + 1).otherwise(F.floor((n1 + n2) / 2) + 1)
    denom = F.greatest(F.lit(1), F.when(mutual, both).otherwise(one_way)).cast("double")  # a page without inlinks
    exponent = F.greatest(F.lit(SMALLEST_EXPONENT), F.least(F.lit(BIGGEST_EXPONENT), F.log(F.lit(BIGGEST_INLINKS) / denom)))
    return (SCALE * F.pow(F.greatest(F.lit(0.0), 1.0 - common / denom), exponent)).cast("int") + F.when(mutual, 10).otherwise(15)


def edge_distances(links: DataFrame) -> DataFrame:
    """(src, dst, common, mutual, n1, n2, distance) of every pair that is linked either way."""
    fwd = links.select("src", "dst", F.lit(1).alias("f"), F.lit(0).alias("b"))
    rev = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0).alias("f"), F.lit(1).alias("b"))
    pairs = fwd.unionByName(rev).groupBy("src", "dst").agg((F.sum("f") * F.sum("b") > 0).alias("mutual"))
    coc = cocitation(links, links.select(F.col("src").alias("p"), F.col("dst").alias("q"))).select(F.col("p").alias("src"), F.col("q").alias("dst"), "n")
    counts = inlink_counts(links)
    full = (
        pairs.join(coc, ["src", "dst"], "left")
        .join(counts.select(F.col("id").alias("src"), F.col("inlinks").alias("n1")), "src", "left")
        .join(counts.select(F.col("id").alias("dst"), F.col("inlinks").alias("n2")), "dst", "left")
        .select("src", "dst", (F.lit(1) + F.coalesce("n", F.lit(0))).alias("common"), "mutual", F.coalesce("n1", F.lit(0)).alias("n1"), F.coalesce("n2", F.lit(0)).alias("n2"))
    )
    return full.withColumn("distance", distance(F.col("n1"), F.col("n2"), F.col("common"), F.col("mutual")))


def title_distances(links: DataFrame, pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, distance) of the pairs (a, b); 255 where either is no page.

    Common here counts a link from b to a, one from a to b, and the pages that link to both.
    """
    into = links.select(F.col("dst").alias("a"), F.col("src").alias("c"))
    onward = links.select(F.col("src").alias("c"), F.col("dst").alias("b"))
    asked = pairs.select("a", "b").distinct()
    through = lookup_join(asked, into.withColumnRenamed("a", "a2"), "a", "a2", "inner", HOT_LINKS).join(onward, ["c", "b"]).groupBy("a", "b").agg(F.count("*").alias("n"))
    ab = links.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(1).alias("ab"))
    ba = links.select(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(1).alias("ba"))
    counts = inlink_counts(links)
    known = pages.select("id")
    full = (
        asked.join(through, ["a", "b"], "left").join(ab, ["a", "b"], "left").join(ba, ["a", "b"], "left")
        .join(counts.select(F.col("id").alias("a"), F.col("inlinks").alias("n1")), "a", "left").join(counts.select(F.col("id").alias("b"), F.col("inlinks").alias("n2")), "b", "left")
        .join(known.select(F.col("id").alias("a"), F.lit(True).alias("ka")), "a", "left").join(known.select(F.col("id").alias("b"), F.lit(True).alias("kb")), "b", "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    d = distance(zero("n1"), zero("n2"), zero("n") + zero("ab") + zero("ba"), F.col("ab").isNotNull() & F.col("ba").isNotNull())
    return full.select("a", "b", F.when(F.col("ka") & F.col("kb"), d).otherwise(NO_RELATION).cast("int").alias("distance"))


def bidi_edges(links: DataFrame, pages: DataFrame) -> DataFrame:
    """(src, dst, distance) of links in text to unambiguous entities: 1 if mutual, else 2, 3 or 4 by falling count."""
    good = pages.filter(~F.col("ambiguous") & F.col("entity")).select(F.col("id").alias("dst"))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("back"))
    d = F.when(F.col("back"), 1).when(F.col("count") > 2, 2).when(F.col("count") > 1, 3).otherwise(4)
    return links.filter("in_text").join(good, "dst", "left_semi").join(back, ["src", "dst"], "left").select("src", "dst", d.alias("distance"))


def top_neighbors(links: DataFrame, pages: DataFrame, n: int) -> DataFrame:
    """(src, dst, score, distance, rank): the n nearest unambiguous entities of every page.

    A link to an unambiguous page scores 1, or a boost by its inlinks when it is mutual; every page q that an unambiguous
    linking page links to scores the count of that link. distance = int(256 * (1 - min(1, score / (inlinks + 1)))).
    """
    clear = pages.filter(~F.col("ambiguous")).select("id")
    counts = inlink_counts(links)
    out_clear = links.join(clear.select(F.col("id").alias("dst")), "dst", "left_semi")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("back"))
    boost = F.greatest(F.lit(4.0), F.coalesce("inlinks", F.lit(0)) / 4.0 + 0.5).cast("int")
    own = out_clear.join(back, ["src", "dst"], "left").join(counts.withColumnRenamed("id", "dst"), "dst", "left").select("src", "dst", F.when(F.col("back"), boost).otherwise(1).cast("long").alias("s"))
    into = links.select(F.col("dst").alias("p"), F.col("src").alias("c")).join(clear.select(F.col("id").alias("c")), "c", "left_semi")
    onward = links.select(F.col("src").alias("c"), F.col("dst").alias("q"), "count")
    two = lookup_join(into, onward.withColumnRenamed("c", "c2"), "c", "c2", "inner", HOT_LINKS).filter(F.col("q") != F.col("p")).groupBy("p", "q").agg(F.sum("count").alias("s"))
    score = own.unionByName(two.select(F.col("p").alias("src"), F.col("q").alias("dst"), "s")).groupBy("src", "dst").agg(F.sum("s").alias("score"))
    good = pages.filter(~F.col("ambiguous") & F.col("entity")).select(F.col("id").alias("dst"))
    full = (
        score.join(good, "dst", "left_semi")
        .join(counts.select(F.col("id").alias("src"), F.col("inlinks").alias("n1")), "src", "left")
        .join(counts.select(F.col("id").alias("dst"), F.col("inlinks").alias("n2")), "dst", "left")
        .select("src", "dst", "score", F.coalesce("n2", F.lit(0)).alias("n2"), (256 * (1.0 - F.least(F.lit(1.0), F.col("score") / (F.coalesce("n1", F.lit(0)) + 1)))).cast("int").alias("distance"))
    )
    w = Window.partitionBy("src").orderBy("distance", "n2", "dst")
    return full.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select("src", "dst", "score", "distance", "rank")


def priority_topics(pages: DataFrame, links: DataFrame) -> DataFrame:
    """(id, inlinks) of unambiguous entities; the order of a priority list is inlinks descending, then id."""
    good = pages.filter(~F.col("ambiguous") & F.col("entity")).select("id")
    return good.join(inlink_counts(links), "id", "left").select("id", F.coalesce("inlinks", F.lit(0)).alias("inlinks"))


def subgraph(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Links around ``seeds`` (id): their outlinks and the links to those ends; their inlinks, the outlinks of these, the links to the ends of those, and the links to the linking pages."""
    s = seeds.select("id").distinct()
    by_src = lambda ids: links.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
    by_dst = lambda ids: links.join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
    out, into = by_src(s), by_dst(s)
    ends, starts = out.select(F.col("dst").alias("id")).distinct(), into.select(F.col("src").alias("id")).distinct()
    from_starts = by_src(starts)
    wide = from_starts.select(F.col("dst").alias("id")).distinct()
    reached = ends.unionByName(starts).unionByName(wide).distinct()
    return out.unionByName(into).unionByName(from_starts).unionByName(by_dst(reached)).dropDuplicates(["src", "dst"])


def canonical_outlinks(outlinks: DataFrame, aliases: DataFrame, drop: str = "|") -> DataFrame:
    """(src, outlinks): targets (src, pos, target) by their canonical names, each once at its first place, joined by '|'.

    Targets without an alias keep their name; those whose canonical name is the drop marker are left out.
    """
    named = outlinks.join(aliases, outlinks["target"] == aliases["alias"], "left").withColumn("name", F.coalesce("canonical", "target")).filter(F.col("name") != drop)
    first = named.groupBy("src", "name").agg(F.min("pos").alias("pos"))
    return first.groupBy("src").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]), "|").alias("outlinks"))


def limited_links(links: DataFrame, most: int) -> DataFrame:
    """The first ``most`` links by falling count, then by their ends; an optional limit of an index."""
    return links.orderBy(F.desc("count"), "src", "dst").limit(most)


def self_relations(relations: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Relations of a page to itself; a sound index has none."""
    return relations.filter(F.col(a) == F.col(b))
