"""Readers, writers, jobs and streams."""

from __future__ import annotations

import struct
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from knotwork.operators import images
from knotwork.operators.infobox_rules import parse_rules, rules_from_csv
from knotwork.plans import jobs
from knotwork.sources import readers, sinks
from knotwork.streaming import queues
from knotwork.wikitext import tree

DUMP = """<mediawiki><page><title>Mill</title><id>1</id><revision><id>2</id><text xml:space="preserve">The [[River|stream]] and [[Town]]. [[Town]] too.</text></revision></page>
<page><title>Stream</title><revision><text>#REDIRECT [[River]]</text></revision></page><page><title>River</title><revision><text>By the [[Mill]] &amp; [[Stream]].</text></revision></page><page><title>Town</title><revision><text>{{disambig}}</text></revision></page></mediawiki>"""


def test_dump_and_index(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP)
    pages = readers.read_dump(spark, f"{tmp_path}/d.xml")
    assert pages.count() == 4 and pages.filter("title = 'River'").first()["text"] == "By the [[Mill]] & [[Stream]]."
    assert rows(readers.dump_links(pages)) == [("Mill", "River"), ("Mill", "Town"), ("River", "Mill"), ("River", "Stream"), ("Stream", "River")]
    jobs.build_index(spark, f"{tmp_path}/d.xml", f"{tmp_path}/i")
    links = {(r["src"], r["dst"]): (r["count"], r["in_text"]) for r in spark.read.parquet(f"{tmp_path}/i/links").collect()}
    assert links == {("Mill", "River"): (1, True), ("Mill", "Town"): (2, True), ("River", "Mill"): (1, True)}
    assert {r["title"]: r["ambiguous"] for r in readers.read_pages_index(spark, f"{tmp_path}/i/pages").collect()} == {"Mill": False, "River": False, "Town": True}
    assert rows(readers.read_redirects_index(spark, f"{tmp_path}/i/redirects")) == [("Stream", "River")]
    assert [r["topic"] for r in readers.read_topics(spark, f"{tmp_path}/i/topics").collect()] == ["Mill", "River"]


def test_lines_and_dictionaries(spark, tmp_path):
    (tmp_path / "p").write_text("1|A|b|1\nbad\n2|C|0\n")
    (tmp_path / "i").write_text("A|/x/y.png\n")
    (tmp_path / "t").write_text("a\tb\tc\nd\te\nf\tg\th\ti\t\n")
    (tmp_path / "n").write_text("<http://dbpedia.org/resource/Old> <p> <o> .\nx\n<http://dbpedia.org/resource/Old> <q> <o> .\n")
    (tmp_path / "b").write_bytes(struct.pack("<8I", 1, 2, 1, 3, 4, 5, 0, 9) + b"\x01")
    assert rows(readers.read_pages_index(spark, f"{tmp_path}/p")) == [(1, "A|b", True), (2, "C", False)]
    assert rows(readers.read_images_index(spark, f"{tmp_path}/i")) == [("A", "/x/y.png")]
    assert rows(readers.read_tsv_triples(spark, f"{tmp_path}/t")) == [("a", "b", "c", None), ("f", "g", "h", "i")]
    assert rows(readers.read_ntriples_subjects(spark, f"{tmp_path}/n")) == [("Old",)]
    assert rows(readers.read_packed_links(spark, f"{tmp_path}/b")) == [(1, 2, 1, 3), (4, 5, 0, 9)]
    kv = lambda *r: spark.createDataFrame(list(r), "key string, value string")
    assert rows(readers.read_outlink_dictionary(kv(("a", "b||c"))), "src", "target") == [("a", "b"), ("a", "c")]
    assert rows(readers.read_distance_dictionary(kv(("a|b", "7"), ("x", "1")))) == [("a", "b", 7)]
    assert rows(readers.read_ranked(kv(("a", "x|1|y|2"), ("b", ""), ("c", "z|q"), ("d", None)), "alias", "canonical")) == [("a", "x", 1), ("a", "y", 2)]
    one = spark.createDataFrame([('["a","b"]', '{"k":"v"}', "x||y", 'z|{"n":"v"}')], "l string, m string, p string, value string")
    r = one.select(readers.json_list(F.col("l")).alias("l"), readers.json_map(F.col("m")).alias("m"), readers.parse_list(F.col("p")).alias("p")).first()
    assert r["l"] == ["a", "b"] and r["m"] == {"k": "v"} and r["p"] == ["x", "", "y"]
    assert rows(readers.zone_rules(one)) == [("z", "n", "v")]
    assert rows(readers.token_index(spark.createDataFrame([(1, "A-b a"), (2, None)], "id int, t string"), "id", "t")) == [("a", 1), ("b", 1)]
    pairs = readers.random_pairs(spark.range(100), 7)
    assert rows(pairs) == rows(readers.random_pairs(spark.range(100), 7)) and pairs.count() == 7


def test_writers(spark, tmp_path):
    sinks.put_all(spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 0)], "key string, value string, seq int"), f"{tmp_path}/kv")
    assert rows(spark.read.parquet(f"{tmp_path}/kv")) == [("a", "2"), ("b", "3")]
    store = sinks.Store(spark, f"{tmp_path}/store")
    for k in range(3):
        store.persist(spark.range(k + 1))
        assert store.load().count() == k + 1
    assert len(store._versions()) <= 2
    sinks.write_parsed(spark.createDataFrame([("a", True, "[]", None), ("b", False, None, "bad")], "title string, ok boolean, sections string, error string"), f"{tmp_path}/good", f"{tmp_path}/bad")
    assert rows(spark.read.parquet(f"{tmp_path}/good")) == [("a", "[]")] and spark.read.json(f"{tmp_path}/bad").count() == 1
    html = spark.createDataFrame([("t", "a\n\nb")], "t string, x string").select(sinks.html_page(F.col("t"), F.col("x")).alias("h")).first()["h"]
    assert "<p>a</p><p>b</p>" in html
    sinks.write_images_xml(spark.createDataFrame([("a", "b")], "title string, path string"), f"{tmp_path}/xml")
    assert spark.read.format("xml").option("rowTag", "image").schema("title string, path string").load(f"{tmp_path}/xml").count() == 1


def test_images_rules_and_rendering(spark):
    names = spark.createDataFrame([("a.png",), ("b.png",), ("a.png",), (None,)], "name string")
    stored = spark.createDataFrame([("a.png",)], "name string")
    assert images.existing_images(names, stored).count() == 2 and rows(images.new_images(names, stored)) == [("b.png",)]
    rec = images.image_records(spark.createDataFrame([(1, "X y.PNG"), (2, "no")], "page int, title string"), spark.createDataFrame([(1, "b"), (1, "a")], "page int, category string"))
    assert rows(rec, "page", "categories") == [(1, "a|b")]
    made = parse_rules(rules_from_csv(["Infobox Mill,owner,BUSINESS,OWNER,10,20,[[X]] owns [[T]]", "x,y,z,,1,2,", "Box,p,C,,5,6,s"]))
    assert made["infobox mill", "owner"]["reverse"] == 20 and made["box", "p"]["subcategory"] is None and len(made) == 2
    assert "internal_link target='b'" in tree.render(tree.parse_sections("{{a|x=[[b]]|c}}\n{|\n|-\n| d\n|}"))


def test_graph_job(spark):
    pages = spark.createDataFrame([("Mill", "The mill by the [[Stream]] is old. It has a [[Wheel]]."), ("River", "A [[Mill]] stands here. [[Category:Rivers]]"), ("Stream", "#REDIRECT [[River]]"), ("Loop", "#REDIRECT [[Loop]]"), ("M", "{{disambig}}\n* [[Mill]]\n"), (None, "x"), ("E", None)], "title string, text string")
    made = jobs.build_graph(pages)
    assert rows(made["redirects"]) == [("Loop", "|"), ("Stream", "River")]
    assert {(r["src"], r["dst"]) for r in made["outlinks"].collect()} == {("Mill", "River"), ("Mill", "Wheel"), ("River", "Mill")}
    rel = {(r["src"], r["dst"]): r["edge_distance"] for r in made["relations"].collect()}
    assert ("Mill", "River") in rel and ("Wheel", "Mill") in rel and all(10 <= d <= 255 for d in rel.values())
    assert ("River", "Stream", 1) in rows(made["aliases"]) and ("Mill", "M", 10) in rows(made["aliases"])
    assert rows(jobs.category_sets(made["about"])) == [("River", "Rivers")]


def test_queue(spark, tmp_path):
    pages = spark.createDataFrame([(f"Page {chr(65 + i)}", "word [[link]]") for i in range(12)] + [("1984", "year"), ("User:x", "y")], "title string, content string").repartition(4)
    queues.enqueue_pages(pages, f"{tmp_path}/in")
    seen = []
    queues.consume(queues.dequeue_pages(spark, f"{tmp_path}/in", most_files=1), lambda df, n: seen.append(df.count()), f"{tmp_path}/c").awaitTermination()
    assert sum(seen) == 12 and len(seen) > 1
    queues.enqueue_pages(pages.limit(3), f"{tmp_path}/in")
    before = sum(seen)
    queues.consume(queues.dequeue_pages(spark, f"{tmp_path}/in"), lambda df, n: seen.append(df.count()), f"{tmp_path}/c").awaitTermination()
    assert 0 < sum(seen) - before <= 3


def test_counts_windows_and_requests(spark, tmp_path):
    e = spark.createDataFrame([(datetime(2024, 1, 1, h, 5), k, f"r{h}") for h in range(6) for k in ("a", "b")], "ts timestamp, kind string, text string")
    e.repartition(3).write.parquet(f"{tmp_path}/e")
    stream = lambda: spark.readStream.schema("ts timestamp, kind string, text string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/e")
    queues.running_counts(stream(), "kind", f"{tmp_path}/o", f"{tmp_path}/k").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/o")) == [("a", 6), ("b", 6)]
    w = queues.windowed_counts(stream(), "ts", "kind", "1 hour", "12 hours")
    w.writeStream.format("memory").queryName("windows").outputMode("update").option("checkpointLocation", f"{tmp_path}/w").trigger(availableNow=True).start().awaitTermination()
    assert spark.sql("select count(distinct start, kind) from windows").first()[0] == 12
    queues.answer_requests(stream(), lambda df: df.select("text", F.upper("kind").alias("answer")), f"{tmp_path}/a", f"{tmp_path}/ak").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/a").count() == 12
