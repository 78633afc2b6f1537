"""Relations, aliases, descriptions and outlinks of page sources.

Parsing is the only step in Python: one Arrow-batched pass emits flat rows; everything after it is relational.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.titles import META_PREFIXES
from knotwork.operators.infobox_rules import RULES, parse_rules
from knotwork.wikitext import flat, tree

#: Commas and semicolons beyond which a sentence outside the first paragraph is no sentence.
MOST_COMMAS = 4
#: Relations whose distance is to be looked up later.
LOOK_UP = -1

EMITS = "page string, kind string, name string, target string, category string, subcategory string, snippet string, distance int, source string"


def is_meta(title: str) -> bool:
    """Whether a title is that of a page that is no article."""
    return title.startswith(META_PREFIXES)


def source_url(title: str) -> str:
    """The address of a page."""
    return "http://en.wikipedia.org/wiki/" + quote(title.replace(" ", "_"), safe="-_.!~*'()")


def query_word(name: str) -> str:
    """The telling words of a name of two to four capitalised words, in lower case; other names whole."""
    parts = name.split()
    if 1 < len(parts) < 5 and all(p[:1].isascii() and p[:1].isupper() for p in parts) and len(parts[-1]) > 2:
        if name.endswith("."):
            name = parts[-2].rstrip(",:;!")
        elif len(parts) > 3:
            name = " ".join(parts[:2])
        elif parts[-1] in ("University", "College"):
            name = " ".join(parts[:-1])
        else:
            name = parts[-1]
    return name.lower()


def key_span(text: str, names: list[str]) -> tuple[int, int] | None:
    """Where one of the names first stands as a word of its own in a text, whatever its case."""
    lower = text.lower()
    for name in names:
        m = re.search(r"(?:^|(?<= ))" + re.escape(name) + r"(?=[,.'\s]|$)", lower) if name else None
        if m:
            return m.span()
    return None


def acronym_fits(text: str, acronym: str) -> bool:
    """Whether the capital initials of the words spell the acronym and the last word has one."""
    words = text.split()
    return bool(words) and "".join(w[0] for w in words if "A" <= w[0] <= "Z") == acronym and "A" <= words[-1][0] <= "Z"


def told(rule: dict, title: str, value: str) -> str:
    """The sentence of a rule for a page and a value."""
    sentence = rule["sentence"]
    for pattern, other in reversed(rule["alternatives"]):
        if re.search(pattern, value):
            sentence = other
            break
    sentence = sentence.replace("[[T]]", f"[[{title}]]", 1).replace("[[X]]", f"[[{value}]]", 1)
    return sentence if sentence[-1:] in ".?!" else sentence + "."


def web_site(url: str) -> str | None:
    """An address with scheme and host in lower case, or none."""
    if not re.match(r"https?://[^.]+\.[^.]+", url, re.I):
        return None
    parts = url.split("/")
    return parts[0].lower() + "//" + parts[2].lower() + "".join("/" + p for p in parts[3:])


class _Page:
    def __init__(self, title: str):
        self.title = title
        self.rows: list[tuple] = []

    def emit(self, kind: str, name: str | None = None, target: str | None = None, page: str | None = None, category=None, subcategory=None, snippet=None, distance=None) -> None:
        self.rows.append((page or self.title, kind, name, target, category, subcategory, snippet, distance, self.title))

    def relation(self, target: str, category: str, subcategory: str, snippet: str, near: int, far: int) -> None:
        """Both directions of a relation; none to the page itself."""
        target = re.sub(r"#.*", "", target)
        if not target or target == self.title:
            return
        self.emit("relation", target=target, category=category, subcategory=subcategory, snippet=snippet, distance=near)
        self.emit("relation", page=target, target=self.title, category=category, subcategory=subcategory, snippet=snippet, distance=far)


def _links_of(value) -> list[str]:
    values = value if isinstance(value, list) else [value]
    return [v["target"] for v in values if isinstance(v, dict) and v.get("type") == "internal_link" and v.get("target")]


def _paragraphs(sections: list) -> list[tuple[str, list[tuple[int, str, str]]]]:
    """Text of each paragraph with its links (place, words, target)."""
    out, text, links = [], "", []
    for s in sections:
        if isinstance(s, str):
            first, *rest = s.split("\n")
            text += first
            for line in rest:
                out.append((text, links))
                text, links = line.lstrip() if not line.strip() else line, []
        elif s["type"] == "internal_link":
            target, words = re.sub(r"#.*", "", s.get("target") or ""), s.get("anchor_text") or s.get("target") or ""
            if target and not is_meta(target):
                links.append((len(text), words, target))
            text += words
    out.append((text, links))
    return [(t, li) for t, li in out if t.strip()]


_SENTENCE_END = re.compile(r'\."?\)?')


def _sentences(page: _Page, text: str, links: list, first: bool, names: list[str]) -> None:
    """A relation for every link of a sentence that ends; lists and tables have none, overlong sentences end a paragraph."""
    if re.match(r"[:*|#]", text):
        return
    span, seen = key_span(text, names), 0
    for place, words, target in links:
        end = _SENTENCE_END.search(text, place + len(words))
        if not end:
            return
        begin = max((m.end() for m in _SENTENCE_END.finditer(text, 0, place)), default=0)
        if len(re.findall(r"[,;]", text[max(begin, seen) : end.end()])) > MOST_COMMAS and not first:
            return
        marks = [(place, place + len(words), target)]
        if span and span[1] <= end.end() and (span[1] <= place or span[0] >= place + len(words)):
            marks.append((*span, page.title))
        snippet = text[: end.end()]
        for a, b, name in sorted(marks, reverse=True):
            snippet = f"{snippet[:a]}[[{name}|{snippet[a:b]}]]{snippet[b:]}"
        page.relation(target, "UNCLASSIFIED", "UNCLASSIFIED", snippet, LOOK_UP, LOOK_UP)


def _ambiguous(page: _Page, sections: list) -> None:
    """Aliases from a disambiguation page: the title is a name of what its lines link to, by how close the words are."""
    name = page.title if page.title.startswith("(") else re.sub(r"\s*\(.+\)", "", page.title)
    acronym = bool(re.fullmatch(r"[A-Z]+", name))
    line: list[tuple[str, int]] = []

    def flush() -> None:
        best = min((d for _, d in line), default=0)
        for target, d in line:
            if d < 30 or d == best:
                page.emit("alias", name=name, page=target, distance=d)
        line.clear()

    for s in sections:
        if isinstance(s, str):
            if "\n" in s:
                flush()
        elif s["type"] == "heading" and isinstance(s.get("value"), str) and s["value"].lower() in ("see also", "similar spellings"):
            break
        elif s["type"] == "internal_link" and s.get("target"):
            words = s.get("anchor_text") or re.sub(r"\s*\([^(]+\)$", "", s["target"])
            short = re.sub(r"\s+(\S+\.|Entertainment|University|College|Company)$", "", words)
            d = 10 if words == name or (acronym and acronym_fits(words, name)) else 20 if short == name else 70 if name in words else 90
            line.append((s["target"], d))
    flush()


def extract_page(title: str, sections: list, rules: dict) -> list[tuple]:
    """Rows (EMITS) of one page."""
    page = _Page(title)
    if is_meta(title):
        return []
    kinds = {s.get("title", "").lower() for s in sections if isinstance(s, dict) and s["type"] == "template"}
    if title.endswith("(disambiguation)") or kinds & {"disambig", "disambiguation"}:
        _ambiguous(page, sections)
        return page.rows
    for s in sections:
        if isinstance(s, dict) and s["type"] == "redirect" and s.get("target"):
            page.emit("redirect", name=title, page=re.sub(r"#.*", "", s["target"]), distance=1)
            return page.rows
    sites: dict[str, str] = {}
    for s in sections:
        if not isinstance(s, dict):
            continue
        if s["type"] == "template":
            params = s.get("parameters") or {}
            if s["title"] == "twitter" and isinstance(params.get("1"), str) and re.fullmatch(r"\w+", params["1"]):
                sites.setdefault("twitter", "http://twitter.com/" + params["1"])
            box = s["title"].lower().replace("_", " ", 1)
            for name, value in params.items():
                rule = rules.get((box, name))
                found = _links_of(value) if rule else []
                if found:
                    page.relation(found[0], rule["category"], rule["subcategory"], told(rule, title, found[0]), rule["distance"], rule["reverse"])
                if name.lower() in ("homepage", "website", "url"):
                    url = value if isinstance(value, str) else value.get("target", "") if isinstance(value, dict) and value.get("type") == "external_link" else ""
                    if url.startswith("http") and web_site(url):
                        sites.setdefault("home_page", web_site(url))
        elif s["type"] == "external_link" and s.get("anchor_sections") and isinstance(s["anchor_sections"][0], str):
            label, url = s["anchor_sections"][0].lower(), s.get("target") or ""
            if any(w in label for w in ("official website", "official web site", "homepage", "home page")) or label == re.sub(r"\s\(.*\)$", "", title).lower():
                if web_site(url):
                    sites.setdefault("home_page", web_site(url))
            elif label.startswith("official twitter") and re.fullmatch(r"http://twitter.com/\w+", url):
                sites.setdefault("twitter", url)
        elif s["type"] == "category":
            page.emit("category", name=s.get("category"))
    paragraphs = _paragraphs(sections)
    if not paragraphs:
        return [r for r in page.rows if r[1] == "relation"]
    names = [title.lower(), query_word(title)]
    for k, (text, links) in enumerate(paragraphs):
        _sentences(page, text, links, k == 0, names)
    page.emit("description", name=re.sub(r"\s?\([^()]*\)", "", paragraphs[0][0]), target=source_url(title))
    page.emit("common_name", name=title if title.startswith("(") else re.sub(r"\s*\([^(]+\)$", "", title))
    for kind, url in sites.items():
        page.emit("site", name=kind, target=url)
    for target in dict.fromkeys(t for _, li in paragraphs for _, _, t in li):
        page.emit("outlink", target=target)
    return page.rows


def extract_relations(pages: DataFrame, title: Column, source: Column, *, rules: str = RULES) -> DataFrame:
    """Flat rows (EMITS) of all pages: relation, redirect, alias, description, common_name, site, category and outlink.

    Pages without a title or source, meta pages and sources that cannot be parsed give no rows. ``rules`` is the text of
    the rules for information boxes.
    """
    names = [f.split()[0] for f in EMITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = parse_rules(rules)
        for batch in batches:
            rows: list[tuple] = []
            for t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sections, error = tree.useful_parse(s, t or "")
                if t and error is None:
                    rows += extract_page(t, sections, table)
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "distance" else pa.string()) for c, n in zip(cols, names)], names=names)

    return pages.select(title.alias("t"), source.alias("s")).filter("t is not null and s is not null").mapInArrow(run, EMITS)


def parse_pages(pages: DataFrame, title: Column, source: Column) -> DataFrame:
    """(title, ok, sections, error): the section tree of every page as JSON text; template pages are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [tree.useful_parse(s, t or "") for t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([e is None for _, e in made]), pa.array([json.dumps(x, ensure_ascii=False) if e is None else None for x, e in made], pa.string()), pa.array([e for _, e in made], pa.string())], names=["title", "ok", "sections", "error"])

    return pages.select(title.alias("title"), source.alias("source")).filter(~F.coalesce(F.col("title").startswith("Template:"), F.lit(False))).mapInArrow(run, "title string, ok boolean, sections string, error string")


def flat_links(pages: DataFrame, title: Column, source: Column) -> DataFrame:
    """(title, redirect, ambiguous, outlinks, images) of every page source."""
    schema = "title string, redirect string, ambiguous boolean, outlinks array<struct<name:string,count:int,in_text:boolean>>, images array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link = pa.list_(pa.struct([("name", pa.string()), ("count", pa.int32()), ("in_text", pa.bool_())]))
        for batch in batches:
            made = [flat.parse_links(s) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.redirect for p in made], pa.string()), pa.array([p.ambiguous for p in made]), pa.array([[dict(zip(("name", "count", "in_text"), o)) for o in p.outlinks] for p in made], link), pa.array([p.images for p in made], pa.list_(pa.string()))], names=["title", "redirect", "ambiguous", "outlinks", "images"])

    return pages.select(title.alias("title"), source.alias("source")).mapInArrow(run, schema)


def plain_pages(pages: DataFrame, title: Column, source: Column) -> DataFrame:
    """(title, text) of pages with a useful title that are no redirects."""
    from knotwork.functions.titles import useful_title

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat.plain_text(s) for s in batch.column(1).to_pylist()], pa.string())], names=["title", "text"])

    kept = pages.select(title.alias("title"), source.alias("source")).filter(useful_title(F.col("title")))
    return kept.mapInArrow(run, "title string, text string").filter("text is not null")
