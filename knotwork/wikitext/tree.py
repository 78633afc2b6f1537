"""A page source as a tree of sections: strings for text and dictionaries with a 'type' for everything else."""

from __future__ import annotations

import re

#: Nesting beyond this is kept as text.
DEEPEST = 60

_TOKEN = re.compile(
    r"""(?P<comment><!--.*?(?:-->|\Z))
    |(?P<raw><(?P<rawtag>nowiki|pre|math|source|gallery|syntaxhighlight)(?:\s[^<>]*)?>(?P<body>.*?)(?:</(?P=rawtag)\s*>|\Z))
    |(?P<selfref><ref\s[^<>]*/>)|(?P<ref><ref(?:\s[^/<>]*)?>)|(?P<refend></ref\s*>)
    |(?P<split>'{2,5}|</?(?:small|big|center)>|<br\s*/?>)
    |(?P<image>\[\[[ \t]*(?:image|file):)|(?P<category>\[\[[ \t]*category[ \t]*:[ \t]*)|(?P<language>\[\[[ \t]*(?P<code>[a-z]{2,3}(?:-[a-z-]+)?|simple)[ \t]*:[ \t]*)
    |(?P<link>\[\[)|(?P<linkend>\]\])|(?P<ext>\[(?=(?:https?|ftp)://))|(?P<extend>\])
    |(?P<tpl>\{\{)|(?P<tplend>\|?\}\})|(?P<table>\{\|)|(?P<tableend>\|\})
    |(?P<heading>={2,5})|(?P<redirect>\#redirect)|(?P<newline>\r?\n|\r)|(?P<bar>\|)|(?P<equals>=)""",
    re.S | re.I | re.X,
)


class _Parser:
    def __init__(self, text: str):
        self.text = text
        self.tokens = list(_TOKEN.finditer(text))
        self.redirect = False

    def kind(self, i: int) -> str:
        return self.tokens[i].lastgroup if self.tokens[i].lastgroup not in ("rawtag", "body", "code") else ("language" if self.tokens[i].group("language") else "raw")

    def sections(self, i: int, at: int, ends: tuple[str, ...], depth: int, trim: bool = False) -> tuple[list, int, int]:
        """Sections from token i and character ``at`` up to a token of ``ends``: (sections, that token or the number of tokens, its start)."""
        out: list = []
        buffer: list[str] = []

        def flush() -> None:
            text = "".join(buffer)
            text = text.strip() if trim else text
            if text:
                out.append(text)
            buffer.clear()

        while i < len(self.tokens):
            m = self.tokens[i]
            if m.start() < at:
                i += 1
                continue
            kind = self.kind(i)
            if kind in ends:
                buffer.append(self.text[at : m.start()])
                flush()
                return out, i, m.start()
            buffer.append(self.text[at : m.start()])
            made = None if depth > DEEPEST else self.construct(kind, i, ends, depth)
            if kind == "redirect":
                self.redirect = True
                at, i = m.end(), i + 1
            elif kind in ("comment", "selfref"):
                at, i = m.end(), i + 1
            elif kind == "split":
                flush()
                at, i = m.end(), i + 1
            elif made is not None:
                flush()
                section, i, at = made
                if section is not None:
                    out.append(section)
            else:
                if kind in ("link", "image", "category", "language"):
                    flush()  # a link that is none starts its text anew
                buffer.append(m.group())
                at, i = m.end(), i + 1
        buffer.append(self.text[at:])
        flush()
        return out, len(self.tokens), len(self.text)

    def construct(self, kind: str, i: int, ends: tuple[str, ...], depth: int):
        m = self.tokens[i]
        if kind == "raw":
            name = m.group("rawtag").lower()
            body = m.group("body")
            if name == "nowiki":
                return body or None, i + 1, m.end()
            return {"type": {"syntaxhighlight": "source"}.get(name, name), "value": body}, i + 1, m.end()
        if kind == "ref":
            inner, j, at = self.sections(i + 1, m.end(), ("refend",), depth + 1)
            return {"type": "ref", "sections": inner}, j + 1, self._after(j, at)
        if kind == "link":
            return self._link(i)
        if kind in ("category", "language"):
            end = self._line_end(i)
            if end is None:
                return None
            body = self.text[m.end() : self.tokens[end].start()].strip()
            if kind == "category":
                return {"type": "category", "category": body.split("|")[0].strip()}, end + 1, self.tokens[end].end()
            return {"type": "language_link", "language": m.group("code").lower(), "target": body}, end + 1, self.tokens[end].end()
        if kind == "image":
            params, j, at = self._params(i + 1, m.end(), "linkend", depth)
            if j >= len(self.tokens):
                return None
            return {"type": "image", "href": params.pop("", ""), "parameters": params}, j + 1, self._after(j, at)
        if kind == "tpl":
            params, j, at = self._params(i + 1, m.end(), "tplend", depth)
            if j >= len(self.tokens):
                return None, j, at  # open at the end of the page
            return {"type": "template", "title": params.pop("", ""), "parameters": params}, j + 1, self._after(j, at)
        if kind == "ext":
            inner, j, at = self.sections(i + 1, m.end(), ("extend", "newline"), depth + 1)
            if j >= len(self.tokens) or self.kind(j) == "newline":
                return None
            head = inner[0] if inner and isinstance(inner[0], str) else ""
            target, _, label = head.partition(" ")
            label_sections = ([label] if label else []) + inner[1:]
            return {"type": "external_link", "target": target, "anchor_sections": label_sections}, j + 1, self._after(j, at)
        if kind == "heading" and "heading" not in ends:
            inner, j, at = self.sections(i + 1, m.end(), ("heading", "newline"), depth + 1, trim=True)
            if j >= len(self.tokens) or self.kind(j) == "newline":
                return None
            return {"type": "heading", "value": inner[0] if len(inner) == 1 else inner}, j + 1, self._after(j, at)
        if kind == "table":
            return self._table(i, depth)
        return None

    def _after(self, j: int, at: int) -> int:
        return self.tokens[j].end() if j < len(self.tokens) else at

    def _line_end(self, i: int) -> int | None:
        """The ']]' that closes a link on its line, when no other link begins before it."""
        for j in range(i + 1, len(self.tokens)):
            kind = self.kind(j)
            if kind == "linkend":
                return j
            if kind in ("newline", "link", "image", "category", "language", "tpl"):
                return None
        return None

    def _link(self, i: int):
        end = self._line_end(i)
        if end is None:
            return None
        body = self.text[self.tokens[i].end() : self.tokens[end].start()]
        target, bar, anchor = body.partition("|")
        if self.redirect:
            return {"type": "redirect", "target": target}, end + 1, self.tokens[end].end()
        return {"type": "internal_link", "target": target, "anchor_text": anchor if bar and anchor else target}, end + 1, self.tokens[end].end()

    def _params(self, i: int, at: int, end: str, depth: int) -> tuple[dict, int, int]:
        """Title under '' and parameters by name, or by number where they have none."""
        first, i, at = self.sections(i, at, ("bar", end), depth + 1, trim=True)
        params: dict = {"": first[0] if first and isinstance(first[0], str) else ""}
        number = 0
        while i < len(self.tokens) and self.kind(i) == "bar":
            value, j, after = self.sections(i + 1, self._after(i, at), ("bar", "equals", end), depth + 1, trim=True)
            key = None
            if j < len(self.tokens) and self.kind(j) == "equals":
                rest, k, after = self.sections(j + 1, self.tokens[j].end(), ("bar", end), depth + 1, trim=True)
                if len(value) <= 1 and all(isinstance(x, str) for x in value):
                    key, value = (value[0] if value else ""), rest
                else:
                    value = [*value, "=", *rest]
                j = k
            if key is None:
                number += 1
                key = str(number)
            if key:
                params[key] = value[0] if len(value) == 1 else value if value else ""
            i, at = j, after
        return params, i, at

    def _table(self, i: int, depth: int):
        """Rows of cells; a cell is {header, style, sections}."""
        start = self.tokens[i].end()
        level, j = 1, i + 1
        while j < len(self.tokens):
            kind = self.kind(j)
            level += (kind == "table") - (kind == "tableend")
            if level == 0:
                break
            j += 1
        if j >= len(self.tokens):
            return None
        body = self.text[start : self.tokens[j].start()]
        rows: list[list[dict]] = []
        style, caption = "", None
        cell: list[str] | None = None
        depth_in, head = 0, False

        def close() -> None:
            nonlocal cell
            if cell is not None and rows:
                text = "\n".join(cell)
                left, bar, right = text.partition("|")
                styled = bool(bar) and "[[" not in left and "{{" not in left
                rows[-1].append({"header": head, "style": left.strip() if styled else "", "sections": parse_sections((right if styled else text).strip(), depth + 1)})
            cell = None

        for k, line in enumerate(body.split("\n")):
            lead = line.lstrip()
            if depth_in == 0 and k == 0:
                style = line.strip()
            elif depth_in == 0 and lead.startswith("|+"):
                caption = lead[2:].strip()
            elif depth_in == 0 and lead.startswith("|-"):
                close()
                if not rows or rows[-1]:  # a row without cells goes on
                    rows.append([])
            elif depth_in == 0 and lead[:1] in ("|", "!") and not lead.startswith("|}"):
                close()
                if not rows:
                    rows.append([])
                head, cell = lead[0] == "!", [lead[1:]]
            elif cell is not None:
                cell.append(line)
            depth_in += line.count("{|") - line.count("|}") + line.count("{{") - line.count("}}")
            depth_in = max(depth_in, 0)
        close()
        if rows and not rows[-1]:
            rows.pop()
        return {"type": "table", "style": style, "caption": caption, "rows": rows}, j + 1, self.tokens[j].end()


def parse_sections(text: str, depth: int = 0) -> list:
    """The sections of a page source in their order."""
    return _Parser(text).sections(0, 0, (), depth)[0]


_MAGIC = re.compile(r"\{\{(SITENAME|SERVER|PAGENAME)\}\}")


def preprocess(text: str, title: str = "", site: str = "Wikipedia", server: str = "http://en.wikipedia.org") -> str:
    """A source without comments and with the magic words filled in."""
    values = {"SITENAME": site, "SERVER": server, "PAGENAME": title}
    return _MAGIC.sub(lambda m: values[m.group(1)], re.sub(r"<!--.*?(?:-->|\Z)", "", text, flags=re.S))


def useful_parse(text: str | None, title: str = "") -> tuple[list | None, str | None]:
    """(sections, error) of a source; null sources and sources nested beyond all bounds have an error."""
    if text is None:
        return None, "null source"
    try:
        return parse_sections(preprocess(text, title or "")), None
    except RecursionError:
        return None, "nested too deeply"


def render(sections: list, indent: int = 0) -> str:
    """A section tree as indented lines, for people to read."""
    out = []
    for s in sections:
        if isinstance(s, str):
            out.append(" " * indent + "text " + repr(s))
            continue
        plain = {k: v for k, v in s.items() if k != "type" and not isinstance(v, (list, dict))}
        out.append(" " * indent + s["type"] + "".join(f" {k}={v!r}" for k, v in plain.items()))
        for k, v in s.items():
            if isinstance(v, dict):
                for name, value in v.items():
                    out.append(" " * (indent + 1) + f"{name}:")
                    out.append(render(value if isinstance(value, list) else [value], indent + 2))
            elif isinstance(v, list):
                for x in v:
                    cells = x if isinstance(x, list) else [x]
                    out.append(render([c if isinstance(c, str) else {"type": "cell", **c} if "type" not in c else c for c in cells], indent + 1))
    return "\n".join(out)
