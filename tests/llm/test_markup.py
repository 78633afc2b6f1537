"""Markup classification and clean text."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from knotwork.llm import markup, queries


def elements(text):
    (_, hit), = markup.classify([text])
    return {markup.ELEMENTS[k] for k in np.flatnonzero(hit.any(0))} if len(hit) else set()


#: Texts that are not in the labelled table.
HELD_OUT = [
    ("Plain words of one line.", ""), ("It rose by 5 * 3 and fell < 2.", ""), ("Call 1-800 #12 & ask for $5 or $6 only.", ""), ("See [4] and {x, y}.", ""), ("path c\\12\\new9", ""), ("a_b_c and ~30", ""),
    ("=== Deep part ===\nwords", "HM"), ("<h4 class='q'>T</h4>", "HM"), ("\\subsubsection{Q}", "HM"), ("#### Four hashes\n\nwords follow here.", "HM"), ("Two words\n=======\n\nrest", "HM"), ("# One title\n\nIts text is here.", "HM"),
    ("words:\n# red\n# green\n# blue", "LM"), ("*a\n*b", "LM"), ("- a\n- b\n- c", "LM"), ("1. a\n2. b", "LM"), ("<ol><li>x</ol>", "LM"), ("; t : d\n; u : e", "LM"), ("\\begin{enumerate}\n\\item x\n\\end{enumerate}", "LM"),
    ("```\n# no heading\n* no list\n$x$\n```", "CM"), ("<pre>\n== x ==\n</pre>", "CM"), ("<source lang='sql'>* x</source>", "CM"), ("\\begin{verbatim}\n\\section{x}\n\\end{verbatim}", "CM"),
    ("so $x^2$ is", "FM"), ("$$\ny = 2\n$$", "FM"), ("<math>z</math>", "FM"), ("\\(a\\)", "FM"), ("{{math|a + b}}", "FM"), ("\\begin{align}x\\end{align}", "FM"),
    ("a <b>b</b>", "M"), ("''i''", "M"), ("[[x|y]]", "M"), ("{{t}}", "M"), ("x &amp; y", "M"), ("<!-- == x == -->w", "M"), ("<nowiki>* x</nowiki> y", "M"), ("a `b` c", "M"), ("#REDIRECT [[X]]", "M"), ("[[open", "M"), ("> said", "M"), ("![p](q.png)", "M"), ("{|\n|-\n| a\n|}", "M"), ("\\textbf{x}", "M"), ("% note\nwords", "M"), ("the <code>x</code> word", "M"),
    ("== H ==\n* l\n* m\n\n```\nc\n```\n$f$", "HLCFM"),
]


@pytest.mark.parametrize(("text", "labels"), HELD_OUT)
def test_held_out(text, labels):
    assert elements(text) == {dict(zip("HLCFM", markup.ELEMENTS))[x] for x in labels}


def test_labelled_table():
    x, y = markup.labelled_blocks()
    assert 100 < len(x) < 1000
    for k, t in enumerate(markup.trees()):
        assert ((t.predict(x) > 0.5) == y[:, k]).all()


def test_the_trees_use_words_links_and_neighbours():
    used = {markup.FEATURES[f] for t in markup.trees() for f in t.feature if f >= 0}
    assert {"link_density", "words_before", "same_before", "underline_after"} <= used and len(markup.FEATURES) < 25


def test_cross_validation():
    """Trees that have not seen a third of the table still know most of it."""
    x, y = markup.labelled_blocks()
    right = []
    for fold in range(3):
        out = np.arange(len(x)) % 3 == fold
        for k in range(len(markup.ELEMENTS)):
            right.append(((markup.Tree(x[~out], y[~out, k]).predict(x[out]) > 0.5) == y[out, k]).mean())
    assert np.mean(right) > 0.95


def test_clean_text():
    source = "== Title ==\n'''Oak''' is a [[tree|big tree]] &amp; old.<ref>x</ref>{{cite|a}}\n* one\n* [[two]]\n<!-- no -->\n<pre>\n* kept\n</pre>\nso <math>x^2</math> holds\n{| class=x\n|-\n| a\n|}\n[[Category:Trees]]"
    assert markup.clean_text(source) == "# Title\n\nOak is a big tree & old.\n\n- one\n- two\n\n```\n* kept\n```\n\nso $x^2$ holds"
    assert markup.clean_text(None) is None and markup.clean_text("") == "" and markup.clean_text("#REDIRECT [[X]]") == ""
    assert markup.clean_text("Plain 9 * 7 < 8 & more_of_it.") == "Plain 9 * 7 < 8 & more_of_it."


def test_operators(spark):
    df = spark.createDataFrame([(1, "== H =="), (1, "== H =="), (2, None), (3, ""), (4, "  \n "), (None, "''x''"), (5, "plain " * 100_000), (6, "[[" * 20_000), (7, "<b" * 20_000), (8, "$" * 5000 + "\\(" * 2000 + "{{math|" * 500)], "id long, text string").withColumn("element", F.lit("clash"))
    got = markup.find_elements(df, F.col("id"), F.col("text"))
    assert rows(got.filter("row_id < 6")) == [(1, "heading"), (1, "markup")] and got.filter("row_id = 6 and element = 'markup'").count() == 1
    assert markup.find_elements(df.limit(0), F.col("id"), F.col("text")).count() == 0
    assert markup.clean_documents(df.filter("id < 6"), F.col("id"), F.col("text")).count() == 6


def test_clean_query_takes_pages_and_aliases(spark, data):
    got = queries.p2_clean(spark, data)
    assert got.columns == ["src", "row_id", "text"]
    for src, row, text in (("raw_pages", "page_id", "content"), ("wiki_links", "link_id", "alias")):
        given = spark.read.parquet(f"{data}/{src}.parquet").select(row, text).distinct().collect()
        assert rows(got.filter(F.col("src") == src), "row_id", "text") == sorted(((r[0], markup.clean_text(r[1])) for r in given), key=str)


@pytest.mark.parametrize(("source", "clean"), [
    ("so {{math|''a'' + b}} and {{math|\\frac{p}{q}}} hold", "so $a + b$ and $\\frac{p}{q}$ hold"),
    ("as $\\frac{a}{b}$ and \\(\\sqrt{x_1}\\) show", "as $\\frac{a}{b}$ and $\\sqrt{x_1}$ show"),
    ("see <nowiki>* [[x]] {{y}}</nowiki> here", "see * [[x]] {{y}} here"),
    ("by <math>x</math> and <math>y < z</math>", "by $x$ and $y < z$"),
    ("== On <math>x^2</math> sums ==\nwords\n* one <math>a_1</math> more\n* two $\\beta$ more", "# On $x^2$ sums\n\nwords\n\n- one $a_1$ more\n- two $\\beta$ more"),
    ("one\n\n{{open|a\n| b\n\ntwo\n\n{| class=x\n| c\n\nthree", "one\n\ntwo\n\nthree"),
    ("one\n\n{{closed|a\n\n| b\n}}\ntwo", "one\n\ntwo"),
    ("paid $5 or $6 only", "paid $5 or $6 only"),
    ("Intro {{broken\nsecond line\n== Head ==\nmore text", "Intro\n\nsecond line\n\n# Head\n\nmore text"),
    ("x {| y\nplain text\nmore text", "x {| y\n\nplain text\n\nmore text"),
    ("before {{box\n| a = 1\n}} after it", "before\n\nafter it"),
    ("$\\frac{a}{b}$", "$\\frac{a}{b}$"),
    ("== Top ==\n=== Deep ===\n* a\n** b\n*** c\n* d", "# Top\n\n## Deep\n\n- a\n  - b\n    - c\n- d"),
    ("# One\n\n## Two\n\n- a\n  - b\n\nSmall\n-----\n\n1. x\n2. y", "# One\n\n## Two\n\n- a\n  - b\n\n## Small\n\n- x\n- y"),
    ("<h3>Part</h3>\n<ul>\n<li>a\n<ul><li>b</li></ul>\n</li>\n<li>c</li>\n</ul>", "### Part\n\n- a\n  - b\n- c"),
    ("\\subsection{Two}\n\\begin{itemize}\n\\item a\n\\begin{enumerate}\n\\item b\n\\end{enumerate}\n\\end{itemize}", "## Two\n\n- a\n  - b"),
])
def test_clean_text_keeps_formulas_and_visible_text(source, clean):
    assert markup.clean_text(source) == clean


def test_clean_text_of_broken_texts():
    for text in ("{{math|" * 500, "$" * 5000 + "\\(" * 2000, "{{\n\n" * 20_000, "{{math|{" * 2000, "<nowiki>{{math|x</nowiki>}}"):
        assert isinstance(markup.clean_text(text), str)
