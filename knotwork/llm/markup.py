"""Markup in texts: which elements a text holds, and clean text that keeps them.

A text is cut into flat blocks: regions that stand for themselves (code, nowiki, comments, displayed formulas) and
lines. Every block is described by its own signs, its number of words and link density, and those of its neighbours, and
classified by decision trees (one an element) that are trained on the small labelled table of ``markup_examples``.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ELEMENTS = ("heading", "list", "code", "formula", "markup")
_LETTER = dict(zip("HLCFM", ELEMENTS))

_CODE, _RAW, _MATH = 1, 2, 3

_REGIONS = re.compile(
    r"""(?P<raw><!--.*?-->|<nowiki\b[^>]*>.*?</nowiki\s*>|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>)
    |(?P<code><(?P<ct>pre|source|syntaxhighlight)\b[^>]*>.*?(?:</(?P=ct)\s*>|\Z)
      |(?m:^)[ ]{0,3}```.*?(?m:^)[ ]{0,3}```[ \t]*(?m:$)|(?m:^)[ ]{0,3}~~~.*?(?m:^)[ ]{0,3}~~~[ \t]*(?m:$)
      |\\begin\{(?P<ce>verbatim|lstlisting|minted)\*?\}.*?(?:\\end\{(?P=ce)\*?\}|\Z)
      |<code\b[^>]*>[^<]*\n.*?</code\s*>)
    |(?P<math><math\b[^>]*>.*?</math\s*>|\$\$(?!\$).+?\$\$|\\\[.+?\\\]|\\begin\{(?P<me>equation|align|gather|displaymath|math|eqnarray|multline)\*?\}.*?\\end\{(?P=me)\*?\})""",
    re.S | re.I | re.X,
)
_INLINE_MATH = re.compile(r"\\\(.+?\\\)|(?<![\w$\\])\$(?=[^\s$])(?:[^$\n]*[^\s$\\])?\$(?![\d$])|\{\{\s*(?:math|mvar)\s*\|[^{}]*(?:\{[^{}]*\}[^{}]*)*\}\}|<math\b|</math>", re.I)
_SIGNS = {
    "wiki_heading": re.compile(r"^\s*(={1,6})(?!=)\s*\S.*?\s*(={1,6})\s*$"),
    "half_heading": re.compile(r"^\s*={2,6}\s*[^\s=][^=]*$"),
    "hashes": re.compile(r"^\s{0,3}#+(?=[^#]|$)"),
    "hash_blank": re.compile(r"^\s{0,3}#{1,6}\s+\S"),
    "html_heading": re.compile(r"</?h[1-6]\b[^<>]*>", re.I),
    "latex_heading": re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\s*(?:\[[^\]]*\])?\{"),
    "underline": re.compile(r"^\s{0,3}(?:={3,}|-{3,})\s*$"),
    "bullet": re.compile(r"^\s*(?:[*+-]\s+\S|\*+[^*\s][^*]*$|\d{1,4}[.)]\s+\S|[•‣◦]\s*\S)"),
    "definition": re.compile(r"^\s*(?:;\s*\S.*:|:+\s*[*#]|:{1,6}\s+\S)"),
    "html_list": re.compile(r"</?(?:ul|ol|li|dl|dt|dd)\b[^<>]*>", re.I),
    "latex_list": re.compile(r"\\(?:item\b|(?:begin|end)\{(?:itemize|enumerate|description)\})"),
    "redirect": re.compile(r"^\s*#\s*redirect\b", re.I),
    "tag": re.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>]*)?/?>"),
    "entity": re.compile(r"&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});", re.I),
    "link": re.compile(r"\[\[|\]\]|\[(?:https?:)?//[^\s\]]+[^\]]*\]?|!?\[[^\[\]]*\]\([^()\s]*\)"),
    "template": re.compile(r"\{\{|\}\}"),
    "emphasis": re.compile(r"''|(?<![\w*])\*\*[^\s*][^*\n]*\*\*|(?<![\w*])\*[^\s*][^*\n]*(?<=\S)\*(?![\w*])|(?<!\w)__?[^\s_][^_\n]*(?<=\S)__?(?!\w)|~~[^\s~][^~\n]*~~|~{3,5}|`[^`\n]+`"),
    "table": re.compile(r"^\s*(?:\{\||\|[-}+]|\|\s|!\s|\|.*\|\s*$)"),
    "quote": re.compile(r"^\s{0,3}>\s*\S"),
    "rule": re.compile(r"^\s*(?:-{3,}|\*{3,}|_{3,})\s*$"),
    "latex": re.compile(r"(?<![\w\\/:])\\[a-zA-Z]{2,}\*?(?!\d)|\\[a-zA-Z]{2,}\*?(?=[\[{])|\\[\[\]()]"),
    "remark": re.compile(r"^%\s?\S"),
    "switch": re.compile(r"__[A-Z]{3,}__"),
}
_LINKS = re.compile(r"\[\[[^\[\]]*\]\]|\[(?:https?:)?//[^\]]*\]|\[[^\[\]]*\]\([^()]*\)|<a\b[^>]*>.*?</a\s*>", re.I | re.S)
_WORD = re.compile(r"\w+")
_LEADING = re.compile(r"^[\s#=*+;:\-\d.)]+")
_UPPER = re.compile(r"[^\w]*\p{Lu}")

#: Characters of which a line must hold one for each sign to be looked for (of the first character of the line where it starts with "^").
_NEEDS = {
    "wiki_heading": "^=", "half_heading": "^=", "hashes": "^#", "hash_blank": "^#", "html_heading": "<", "latex_heading": "\\", "underline": "^=-", "bullet": "^*+-0123456789•‣◦", "definition": "^;:", "html_list": "<", "latex_list": "\\",
    "redirect": "^#", "tag": "<", "entity": "&", "link": "[]", "template": "{}", "emphasis": "'*_~`", "table": "^{|!", "quote": "^>", "rule": "^-*_", "latex": "\\", "remark": "^%", "switch": "_",
}
_ANY_SIGN = re.compile(r"[<&\[\]{}'*_~`\\$]")
_LEAD = {c: [n for n, need in _NEEDS.items() if need[0] == "^" and c in need[1:]] for c in sorted({c for need in _NEEDS.values() if need[0] == "^" for c in need[1:]})}
#: Other digits than ASCII ones may begin an item, too.
_INSIDE = {n: need for n, need in _NEEDS.items() if need[0] != "^"}

#: Signs that mean the same are one feature; what is left open by them (a hash before a title or an item, a line under a
#: title or between parts) is told by the words, the links and the neighbours of the block.
_MEANING = {
    "heading_sign": ("wiki_heading", "half_heading", "html_heading", "latex_heading"), "list_sign": ("bullet", "definition", "html_list", "latex_list"), "underline": ("underline",), "redirect": ("redirect",),
    "other_sign": ("redirect", "tag", "entity", "link", "template", "emphasis", "table", "quote", "rule", "latex", "remark", "switch", "html_heading", "latex_heading", "html_list", "latex_list"),
}
FEATURES = ("words", "link_density", "words_before", "words_after", "density_before", "density_after", *_MEANING, "hash", "math", "code", "raw", "upper", "same_before", "same_after", "underline_after", "blank_before", "blank_after", "end_stop")


@dataclass
class Block:
    """A flat block: its text, what region it holds, and whether blank lines stand next to it."""

    text: str
    code: int = 0
    raw: int = 0
    math: int = 0
    blank_before: bool = False
    blank_after: bool = False
    held: str = ""
    #: The text with a mark (two zero bytes around a number) at the place of each region, and what the regions hold.
    marked: str = ""
    regions: tuple[tuple[str, int, str], ...] = ()


def blocks_of(text: str) -> list[Block]:
    """The flat blocks of a text in their order."""
    out: list[Block] = []
    held: list[tuple[int, str]] = []

    def mark(m) -> str:
        kind = _CODE if m.group("code") else _RAW if m.group("raw") else _MATH
        held.append((kind, m.group(0)))
        return f"\n\x00{len(held) - 1}\x00\n" if kind == _CODE else f"\x00{len(held) - 1}\x00"

    blank = True
    for line in re.split(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]", _REGIONS.sub(mark, text.replace("\x00", " "))):
        if not line.strip():
            blank = True
            if out:
                out[-1].blank_after = True
            continue
        b = Block(line, blank_before=blank, marked=line)
        for i in re.findall(r"\x00(\d+)\x00", line):
            kind, body = held[int(i)]
            b.regions += ((i, kind, body),)
            b.held += body
            if kind == _CODE:
                b.code += 1
            elif kind == _RAW:
                b.raw += 1
            else:
                b.math += 1
        b.text = re.sub(r"\x00\d+\x00", " ", line) if b.held else line
        out.append(b)
        blank = False
    if out:
        out[-1].blank_after = True
    return out


def signs_of(line: str) -> set[str]:
    """The signs of markup that a line holds; only those are looked for of which it holds a character."""
    out = set()
    lead = line.lstrip()[:1]
    for n in _LEAD.get(lead, _LEAD["0"] if lead.isdigit() else ()):
        if _SIGNS[n].search(line):
            out.add(n)
    if _ANY_SIGN.search(line):
        for n, need in _INSIDE.items():
            if any(c in line for c in need) and _SIGNS[n].search(line):
                out.add(n)
    return out


_COL = {f: i for i, f in enumerate(FEATURES)}


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    n = len(blocks)
    rows = [[0.0] * len(FEATURES) for _ in blocks]
    first = []
    for b, r in zip(blocks, rows):
        t = b.text
        signs = signs_of(t)
        if signs:
            for name, which in _MEANING.items():
                r[_COL[name]] = float(not signs.isdisjoint(which))
            if "hashes" in signs:
                r[_COL["hash"]] = 1.0
        links = sum(len(_WORD.findall(x)) for x in _LINKS.findall(t)) if "[" in t or "<" in t else 0
        words = len(_WORD.findall(t))
        r[_COL["math"]] = float(b.math > 0 or any(c in t for c in "$\\{<") and bool(_INLINE_MATH.search(t)))
        r[_COL["code"]], r[_COL["raw"]] = b.code, b.raw
        r[_COL["words"]], r[_COL["link_density"]] = min(words, 60), links / words if words else 0
        r[_COL["upper"]] = bool(_UPPER.match(_LEADING.sub("", t)))
        r[_COL["blank_before"]], r[_COL["blank_after"]] = b.blank_before, b.blank_after
        r[_COL["end_stop"]] = t.rstrip()[-1:] in ".!?\"”)"
        mark = t.lstrip()[:1]
        first.append(mark if mark and mark in "#*+-;:" else "digit" if mark.isdigit() else "")
    x = np.array(rows, float).reshape(n, len(FEATURES))
    if n < 2:
        x[:, [_COL["words_before"], _COL["words_after"]]] = -1
        return x
    same = np.array([a != "" and a == b for a, b in zip(first, first[1:])])
    near = np.array([not b.blank_after for b in blocks[:-1]])
    x[1:, _COL["same_before"]] = x[:-1, _COL["same_after"]] = same & near
    x[:-1, _COL["underline_after"]] = x[1:, _COL["underline"]] * near
    for what in ("words", "density"):
        value = x[:, _COL["words" if what == "words" else "link_density"]]
        end = -1 if what == "words" else 0
        x[:, _COL[f"{what}_before"]] = np.concatenate([[end], value[:-1]])
        x[:, _COL[f"{what}_after"]] = np.concatenate([value[1:], [end]])
    return x


class Tree:
    """A binary decision tree by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
        self.feature: list[int] = []
        self.cut: list[float] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.value: list[float] = []
        self._grow(x, y.astype(float), depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        me = len(self.value)
        for column, v in ((self.feature, -1), (self.cut, 0.0), (self.low, -1), (self.high, -1), (self.value, float(y.mean()) if len(y) else 0.0)):
            column.append(v)
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return me
        best = None
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            xs, ys = x[order, f], y[order]
            k = np.flatnonzero(np.diff(xs) > 0) + 1
            if not len(k):
                continue
            left = np.cumsum(ys)[k - 1]
            n, total = len(ys), ys.sum()
            pl, pr = left / k, (total - left) / (n - k)
            g = k * pl * (1 - pl) + (n - k) * pr * (1 - pr)
            j = int(np.argmin(g))
            if best is None or g[j] < best[0] - 1e-12:
                best = (g[j], f, (xs[k[j] - 1] + xs[k[j]]) / 2)
        if best is None or best[0] >= len(y) * self.value[me] * (1 - self.value[me]) - 1e-12:
            return me
        _, f, cut = best
        on = x[:, f] > cut
        self.feature[me], self.cut[me] = f, cut
        self.low[me] = self._grow(x[~on], y[~on], depth - 1, least)
        self.high[me] = self._grow(x[on], y[on], depth - 1, least)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of positive examples in the leaf of each row."""
        at = np.zeros(len(x), int)
        feature, cut, low, high = map(np.array, (self.feature, self.cut, self.low, self.high))
        while True:
            on = feature[at] >= 0
            if not on.any():
                return np.array(self.value)[at]
            f = feature[at[on]]
            go = x[np.flatnonzero(on), f] > cut[at[on]]
            at[on] = np.where(go, high[at[on]], low[at[on]])


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (one column an element) of the labelled table."""
    from knotwork.llm.markup_examples import EXAMPLES

    xs, ys = [], []
    for example in EXAMPLES:
        blocks = blocks_of("\n".join(t for t, _ in example))
        labels = [lab for t, lab in example if t.strip()]
        if len(blocks) != len(labels):
            raise ValueError(f"{len(blocks)} blocks, {len(labels)} labels: {example}")
        xs.append(features_of(blocks))
        ys += [[e in {_LETTER[c] for c in lab} or (e == "markup" and bool(lab)) for e in ELEMENTS] for lab in labels]
    return np.concatenate(xs), np.array(ys, bool)


class Rest(Tree):
    """A tree for what other trees have not said yes to: yes where one of them or the tree itself does."""

    def __init__(self, x: np.ndarray, y: np.ndarray, others: tuple[Tree, ...]):
        super().__init__(x, y)
        self.others = others

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.max([super().predict(x), *(t.predict(x) for t in self.others)], axis=0)


@lru_cache(maxsize=1)
def trees() -> tuple[Tree, ...]:
    """The trees of ELEMENTS, trained on the labelled table (some hundred rows, all of it).

    Blocks that are one of the other elements are markup by that; the tree for markup learns from the rest.
    """
    x, y = labelled_blocks()
    rest = ~y[:, :-1].any(1)
    single = tuple(Tree(x, y[:, k]) for k in range(len(ELEMENTS) - 1))
    return (*single, Rest(x[rest], y[rest, -1], single))


def classify(texts: list[str | None]) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks of each text and, for each block, which of ELEMENTS it is; all blocks go through the trees at once."""
    cut = [blocks_of(t) if t else [] for t in texts]
    sizes = [len(b) for b in cut]
    x = np.concatenate([features_of(b) for b in cut if b] or [np.zeros((0, len(FEATURES)))])
    hit = np.stack([t.predict(x) > 0.5 for t in trees()], 1) if len(x) else np.zeros((0, len(ELEMENTS)), bool)
    return [(b, h) for b, h in zip(cut, np.split(hit, np.cumsum(sizes)[:-1]))] if sizes else []


def find_elements(df: DataFrame, row_id: Column, text: Column) -> DataFrame:
    """(row_id, element) for every element of ELEMENTS that a text holds at least once.

    Null, empty and blank texts hold none. Repeated ids count once, with all that their rows hold. Texts are read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, out_id, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], []
            listed = list(set(texts))  # equal texts are classified once
            held = {t: [ELEMENTS[k] for k in np.flatnonzero(hit.any(0))] if len(hit) else [] for t, (_, hit) in zip(listed, classify(listed))}
            for i, t in zip(ids, texts):
                for e in held[t]:
                    out_id.append(i)
                    out.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out, pa.string())], names=["row_id", "element"])

    rows = df.select(row_id.cast("long").alias("row_id"), text.cast("string").alias("text")).filter(F.col("row_id").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(run, "row_id long, element string").distinct()


_STRIP = [
    (re.compile(r"<!--.*?-->", re.S), ""), (re.compile(r"<(script|style)\b[^>]*>.*?</\1\s*>", re.S | re.I), ""), (re.compile(r"<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref\s*>", re.S | re.I), ""), (re.compile(r"</?nowiki\s*/?>", re.I), ""),
    (re.compile(r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", re.I), ""), (re.compile(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]"), r"\1"), (re.compile(r"\[\[([^\[\]]*)\]\]"), r"\1"), (re.compile(r"\[(?:https?:)?//[^\s\]]+\s*([^\]]*)\]"), r"\1"),
    (re.compile(r"!\[([^\[\]]*)\]\([^()]*\)"), ""), (re.compile(r"\[([^\[\]]*)\]\([^()]*\)"), r"\1"), (re.compile(r"\{\{(?:nowrap|lang\|[^|{}]*)\|([^{}|]*)\}\}", re.I), r"\1"), (re.compile(r"\{\{[^{}]*\}\}"), ""),
    (re.compile(r"\\(?:cite|ref|label|footnote)\*?(?:\[[^\]]*\])?\{[^{}]*\}"), ""), (re.compile(r"\\(?:begin|end)\{[^{}]*\}"), ""), (re.compile(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}"), r"\1"), (re.compile(r"\\LaTeX\b"), "LaTeX"), (re.compile(r"^%.*$"), ""),
    (re.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>]*)?/?>"), ""), (re.compile(r"'{2,5}"), ""), (re.compile(r"(?<!\w)(\*\*|__|~~|\*|_|`)(?=\S)(.+?)(?<=\S)\1(?!\w)"), r"\2"), (re.compile(r"\[\[|\]\]|\{\{|\}\}"), ""),
]


def _plain(text: str) -> str:
    for pattern, new in _STRIP:
        text = pattern.sub(new, text)
    return re.sub(r"[ \t\xa0]+", " ", html.unescape(text)).strip()


#: Inline formulas: {{math|x}}, \(x\) and $x$ as _INLINE_MATH finds them.
_INLINE = re.compile(r"\{\{\s*(?:math|mvar)\s*\|(?P<t>(?:[^{}]++|(?P<g>\{(?:[^{}]++|(?&g))*+\}))*+)\}\}|\\\((?P<p>.+?)\\\)|(?<![\w$\\])\$(?=[^\s$])(?P<d>(?:[^$\n]*[^\s$\\])?)\$(?![\d$])", re.I)
_NOWIKI = re.compile(r"<nowiki\b[^>]*>(.*)</nowiki\s*>", re.S | re.I)
_DISPLAYED = re.compile(r"<math\b[^>]*>(.*)</math\s*>|\$\$(.+)\$\$|\\\[(.+)\\\]|\\begin\{\w+\*?\}(.*)\\end\{\w+\*?\}", re.S | re.I)
_MARK = re.compile(r"\x00(\d+)\x00")


def _formula(region: str) -> str:
    m = _DISPLAYED.fullmatch(region)
    return "$" + " ".join((re.sub(r"</?[a-zA-Z][^<>]*>", "", next(g for g in m.groups() if g is not None)) if m else region).split()) + "$"


def _hold(b: Block) -> tuple[str, dict[str, str]]:
    """The line of a block with marks for what is kept as it stands, formulas and texts within nowiki, and what the marks hold."""
    kept: dict[str, str] = {}
    kinds = {i: (kind, body) for i, kind, body in b.regions}

    def region(m) -> str:
        kind, body = kinds[m.group(1)]
        if kind == _RAW and (text := _NOWIKI.fullmatch(body)):
            kept[m.group(1)] = html.unescape(text.group(1))
        elif kind == _MATH:
            kept[m.group(1)] = _formula(body)
        else:
            return " "
        return m.group(0)

    def inline(m) -> str:
        if m.group("t") is not None:
            body = html.unescape(re.sub(r"'{2,5}|^\s*1\s*=\s*", "", m.group("t")))
        else:
            body = m.group("p") if m.group("p") is not None else m.group("d")
        mark = str(10**9 + len(kept))  # beyond the numbers of regions
        kept[mark] = f"${' '.join(body.split())}$"
        return f"\x00{mark}\x00"

    return _INLINE.sub(inline, _MARK.sub(region, b.marked)), kept


def _put_back(text: str, kept: dict[str, str]) -> str:
    while _MARK.search(text):  # a formula may hold a nowiki region
        text = _MARK.sub(lambda m: kept[m.group(1)], text)
    return text


def _unclosed(depths: list[int]) -> list[bool]:
    """For each block, whether a template or table that it opens outside of others is never closed; ``depths``: brackets opened less those closed in each."""
    total = np.cumsum([0, *depths])
    least = np.minimum.accumulate(total[::-1])[::-1]
    return [bool(least[i + 1] > total[i]) for i in range(len(depths))]


_BRACES = re.compile(r"\{\{|\}\}")
_TABLE_START, _TABLE_END = re.compile(r"^\s*\{\|"), re.compile(r"^\s*\|\}")
_LEFT_OUT = re.compile(r"\s*(?:\||!\s|#\s*redirect\b)", re.I)
_NESTS, _UNNESTS = re.compile(r"<(?:ul|ol|dl)\b|\\begin\{(?:itemize|enumerate|description)\}", re.I), re.compile(r"</(?:ul|ol|dl)\s*>|\\end\{(?:itemize|enumerate|description)\}", re.I)
_LEVELS = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
_LATEX_TITLE = re.compile(r"\\(part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\s*(?:\[[^\]]*\])?\{([^{}]*)\}")
_FENCES = re.compile(r"^\s*(?:<[^<>]*>\s*)+|(?:<[^<>]*>\s*)+$|^\s*(?:```|~~~)[^\n]*\n|\n?\s*(?:```|~~~)\s*$|\\(?:begin|end)\{[^{}]*\}")


def _outside(line: str, depth: int, closes: bool) -> tuple[str, int]:
    """What of a line is outside of templates that other lines begin or end, and the depth at its end.

    A template that opens here and that no line closes ends with the line.
    """
    opens: list[int] = []
    start = 0
    for m in _BRACES.finditer(line):
        if m.group() == "{{":
            if depth:
                depth += 1
            else:
                opens.append(m.start())
        elif depth:
            depth -= 1
            start = m.end() if not depth else start
        elif opens:
            opens.pop()
    if depth:
        return "", depth
    return (line[start : opens[0]], len(opens) if closes else 0) if opens else (line[start:], 0)


def _level(line: str, after: str) -> int:
    """The level of a heading; the second level of wiki markup is the first within a page."""
    if m := _SIGNS["wiki_heading"].match(line) or _SIGNS["half_heading"].match(line):
        return max(1, len(line.strip()) - len(line.strip().lstrip("=")) - 1)
    if m := re.search(r"</?h([1-6])", line, re.I):
        return int(m.group(1))
    if m := _LATEX_TITLE.search(line):
        return _LEVELS[m.group(1)]
    if m := re.match(r"\s*(#{1,6})", line):
        return len(m.group(1))
    return 2 if after.lstrip()[:1] == "-" and _SIGNS["underline"].match(after) else 1


def clean_text(text: str | None) -> str | None:
    """Text without markup: headings as '# x' with a hash for each level, list items as '- x' indented by two blanks for each
    level, code blocks fenced, formulas as $x$ at their place, nowiki texts as they stand.

    Null for null. Redirect lines, tables, templates, comments and files are left out; what stands in a line before or
    after a template of several lines is kept. A template or table that is never closed ends with its line, and lines
    after it that look like its cells or parameters are left out.
    """
    return clean_texts([text])[0]


def clean_texts(texts: list[str | None]) -> list[str | None]:
    """``clean_text`` of each text; equal texts are cleaned once."""
    listed = list({t for t in texts if t is not None})
    done: dict[str | None, str | None] = {t: _cleaned(blocks, hit) for t, (blocks, hit) in zip(listed, classify(listed))}
    return [done.get(t) for t in texts]


def _cleaned(blocks: list[Block], hit: np.ndarray) -> str:
    is_a = {e: hit[:, k].tolist() if len(hit) else [] for k, e in enumerate(ELEMENTS)}
    held = [_hold(b) for b in blocks]
    whole = [is_a["code"][i] and b.code for i, b in enumerate(blocks)]
    opened = [0 if w else line.count("{{") - line.count("}}") for w, (line, _) in zip(whole, held)]
    tables = [0 if w else bool(_TABLE_START.match(line)) - bool(_TABLE_END.match(line)) for w, (line, _) in zip(whole, held)]
    lost, lost_table = _unclosed(opened), _unclosed(tables)
    parts: list[tuple[str, str]] = []
    depth = table = nested = 0
    for i, (b, (line, kept)) in enumerate(zip(blocks, held)):
        if whole[i]:
            parts.append(("code", "```\n" + _FENCES.sub("", b.held).strip("\n") + "\n```"))
            continue
        if not depth and _TABLE_START.match(line):
            table += not lost_table[i]
            continue
        if table:
            if not _TABLE_END.match(line):
                continue
            table -= 1
            line = _TABLE_END.sub("", line)
        line, depth = _outside(line, depth, not lost[i])
        if not line.strip() or _LEFT_OUT.match(line) or _SIGNS["underline"].match(b.text) or _SIGNS["rule"].match(b.text):
            continue
        if is_a["heading"][i]:
            plain = _put_back(_plain(re.sub(r"^[\s=#]+|[\s=#]+$", "", _LATEX_TITLE.sub(r"\2", line))), kept)
            level = _level(b.text, blocks[i + 1].text if i + 1 < len(blocks) and not b.blank_after else "")
            parts += [("heading", f"{'#' * level} {plain}")] if plain else []
        elif is_a["list"][i]:
            at = 0
            for m in re.finditer(r"<(?:li|dt|dd)\b[^<>]*>|\\item\b|\Z", line, re.I):
                item, at = line[at : m.start()], m.end()
                wiki = re.match(r"\s*([*#;:]+)", item)
                deep = max(nested - 1, len(wiki.group(1)) - 1 if wiki else (len(item) - len(item.lstrip())) // 2 if re.match(r"\s*(?:[+-]|\d+[.)])\s", item) else 0, 0)
                nested = max(0, nested + len(_NESTS.findall(item)) - len(_UNNESTS.findall(item)))
                plain = _plain(re.sub(r"^\s*(?:[*#;:+-]+|\d+[.)])\s*", "", item))
                parts += [("list", f"{'  ' * deep}- {_put_back(plain, kept)}")] if plain else []
        else:
            plain = _put_back(_plain(line), kept)
            parts += [("text", plain)] if plain else []
    joined = ""
    for k, (kind, part) in enumerate(parts):
        joined += ("" if not k else "\n" if kind == "list" == parts[k - 1][0] else "\n\n") + part
    return joined


def clean_documents(df: DataFrame, row_id: Column, text: Column) -> DataFrame:
    """(row_id, text): clean text of every row (see ``clean_text``); rows are neither dropped nor merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean_texts(batch.column(1).to_pylist()), pa.string())], names=["row_id", "text"])

    return df.select(row_id.cast("long").alias("row_id"), text.cast("string").alias("text")).mapInArrow(run, "row_id long, text string")
