"""Links, images, redirect and ambiguity of a page source, and its plain text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_RAW = re.compile(r"<(nowiki|math|pre)>.*?(?:</\1>|\Z)|<ref(?:\s[^/>]*)?>.*?(?:</ref>|\Z)|<ref\s[^/>]*/>", re.S | re.I)
_AMBIGUOUS = re.compile(r"\{\{disambig\}\}|\{\{surname\|nocat\}\}|\{\{given name\}\}|\[\[Category:Given names\]\]", re.I)
_IMAGE = re.compile(r"\s*([^ \[{\s][ -~]+?\.(?:jpg|jpeg|svg|gif|png))(?![ -~]*\.(?:jpg|jpeg|svg|gif|png))", re.I)
_MARKS = re.compile(r"\[\[|\]\]|\{\{|\}\}|\{\||\|\}|\r\n|[\r\n|=:#]")
_REDIRECT = re.compile(r"#redirect", re.I)


def sanitize_title(text: str) -> str | None:
    """A written title without outer white space, with blanks for tabs, line ends and underscores; null when nothing is left."""
    return re.sub(r"[\r\n\t_]", " ", text.strip(" \r\n\t_")) or None


def image_name(text: str) -> str | None:
    """The image file with which a value starts."""
    m = _IMAGE.match(text)
    return m.group(1) if m else None


@dataclass
class FlatPage:
    """What a page links to: names with count and whether one of the links stands in the text."""

    redirect: str | None = None
    ambiguous: bool = False
    outlinks: list[tuple[str, int, bool]] = field(default_factory=list)
    images: list[str] = field(default_factory=list)


@dataclass
class _Open:
    kind: str
    start: int
    end: int = -1
    bad: bool = False
    value: int = -1


def parse_links(source: str | None) -> FlatPage:
    """Links of a page source; null and empty sources have none.

    Comments, raw regions, references and tables are left out. A link with a colon, a line end or a template in its target
    is none; its target ends at the first '|' or '#'. A link stands in the text unless it is inside another construct. Images
    are image links and values of template parameters that name an image file. On a redirect only its target counts.
    """
    page = FlatPage()
    if not source:
        return page
    page.ambiguous = bool(_AMBIGUOUS.search(source))
    text = _RAW.sub("\x00", _COMMENT.sub("\x00", source))
    redirect = _REDIRECT.search(text)
    links: dict[str, list] = {}
    images: dict[str, None] = {}
    stack: list[_Open] = []
    tables = 0

    def image(start: int, end: int) -> None:
        name = image_name(text[start:end])
        if name:
            images[name] = None

    for m in _MARKS.finditer(text):
        t, at = m.group(), m.start()
        if t == "{|":
            tables += 1
        elif t == "|}":
            tables = max(0, tables - 1)
        elif tables:
            continue
        elif t == "{{":
            if stack and stack[-1].kind == "link" and stack[-1].end < 0:
                stack[-1].bad = True
            stack.append(_Open("template", m.end()))
        elif t == "[[":
            is_image = re.compile(r"\s*(?:image|file):", re.I).match(text, m.end())
            stack.append(_Open("image" if is_image else "link", is_image.end() if is_image else m.end()))
        elif not stack:
            continue
        elif t == "}}":
            top = stack.pop()
            if top.kind == "template" and top.value >= 0:
                image(top.value, at)
        elif t == "]]":
            top = stack.pop()
            end = top.end if top.end >= 0 else at
            if top.kind == "image":
                image(top.start, end)
            elif top.kind == "link" and not top.bad:
                name = sanitize_title(text[top.start : end].replace("\x00", ""))
                if name and redirect and redirect.start() < top.start:
                    page.redirect = name
                    break
                if name:
                    entry = links.setdefault(name, [0, False])
                    entry[0] += 1
                    entry[1] = entry[1] or not stack
        else:
            top = stack[-1]
            if top.kind == "template":
                if t == "|":
                    if top.value >= 0:
                        image(top.value, at)
                    top.value = -1
                elif t == "=" and top.value < 0:
                    top.value = m.end()
            elif t in "|#":
                top.end = at if top.end < 0 else top.end
            elif t == ":" and top.kind == "link":
                top.bad = True
            elif t in ("\n", "\r", "\r\n") and top.kind == "link" and top.end < 0:
                top.bad = True
    page.outlinks = [(n, c, i) for n, (c, i) in links.items()] if page.redirect is None else []
    page.images = list(images)
    return page


_INNER_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
_INNER_TABLE = re.compile(r"\{\|(?:(?!\{\|).)*?\|\}", re.S)
_FILE_LINK = re.compile(r"\[\[\s*(?:image|file|category|[a-z]{2,3}(?:-[a-z-]+)?)\s*:[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]", re.I)


def plain_text(source: str | None) -> str | None:
    """Text of a page with its links as [[target|words]]; null for redirects and null sources.

    Templates, tables, references, images, categories and all other markup are left out.
    """
    if source is None or _REDIRECT.match(source.lstrip()):
        return None
    text = _RAW.sub("", _COMMENT.sub("", source))
    for pattern in (_INNER_TEMPLATE, _INNER_TABLE):
        before = None
        while before != text:
            before, text = text, pattern.sub("", text)
    text = _FILE_LINK.sub("", text)
    text = re.sub(r"\[(?:https?|ftp)://\S+\s*([^\]]*)\]", r"\1", text)
    text = re.sub(r"'{2,5}|={2,6}|<[^<>]*>|__[A-Z]+__|^[*#:;]+\s*|^-{4,}$", "", text, flags=re.M)
    text = re.sub(r"\[\[([^\[\]|]*)\]\]", r"[[\1|\1]]", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()
