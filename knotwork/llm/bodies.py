"""Concept bodies as flat rows: names, edges and what else tells records apart, whatever encoding a field comes in."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that only say that nothing is known (fixed values; compared in lower case, without signs and outer blanks).
NOTHING = ("unknown", "n/a", "na", "none", "null", "nil", "tbd", "no name", "not available", "not known", "unnamed", "untitled", "missing", "undefined", "no description", "no data", "nan", "not specified", "unspecified", "to be determined", "anonymous", "empty", "no title", "no text", "not applicable")

_SIGNS = re.compile(r"[\W_]+")
_PAREN = re.compile(r"\s*\(([^()]*)\)")
_NUMBER = re.compile(r"[\s_-]*\d+$")


def is_real(value) -> bool:
    """Whether a value is a text that says something: not blank, not only signs, none of NOTHING."""
    if not isinstance(value, str):
        return False
    words = _SIGNS.sub(" ", value.lower()).strip()
    return bool(words) and words not in _NOTHING


_NOTHING = {_SIGNS.sub(" ", x).strip() for x in NOTHING}


def parse(text: str | None) -> dict:
    """The body as an object; empty when it is no valid JSON or no object."""
    try:
        value = json.loads(text) if text is not None else None
        if isinstance(value, str):
            value = json.loads(value)
    except (ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def listed(value) -> list:
    """A collection in whatever shape as a list: array, {items: [...]}, {"0": ...}, or a single value."""
    if value is None:
        return []
    if isinstance(value, dict):
        if len(value) == 1 and isinstance(value.get("items"), (list, dict)):
            return listed(value["items"])
        if value and all(k.isdigit() for k in value):
            return list(value.values())
        return [value] if value else []
    return value if isinstance(value, list) else [value]


def names_of(body: dict) -> list[str]:
    """Real names of a body: the common name and the aliases."""
    out = [body.get("common_name")]
    for alias in listed(body.get("aliases")):
        out.append(alias.get("name") if isinstance(alias, dict) else alias)
    return [n for n in out if is_real(n)]


def description_texts(body: dict) -> list[str]:
    """Real texts among the descriptions."""
    out = [d.get("text") if isinstance(d, dict) else d for d in listed(body.get("descriptions"))]
    return [t for t in out if is_real(t)]


def edge_names(body: dict) -> list[str]:
    """Names of the edges that say something."""
    edges = body.get("edges")
    names = list(edges) if isinstance(edges, dict) else [e.get("name") if isinstance(e, dict) else e for e in listed(edges)]
    return [n for n in names if is_real(n)]


def fold(text: str) -> str:
    """Lower case without accents, parentheses, signs and repeated blanks."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", _PAREN.sub("", text.replace("_", " ")).lower()) if not unicodedata.combining(c))
    return _SIGNS.sub(" ", plain).strip()


def name_forms(name: str) -> set[str]:
    """Forms under which a name is compared: folded, and without a trailing number."""
    out = {fold(name), fold(_NUMBER.sub("", _PAREN.sub("", name)))}
    return {x for x in out if x}


def kinds_in(name: str) -> set[str]:
    """What stands in parentheses in a name, numbers left out."""
    return {k for k in (m.strip().lower() for m in _PAREN.findall(name.replace("_", " "))) if k and not k.isdigit()}


def group_key(col: Column) -> Column:
    """Concept keys are equal but for case, underscores for blanks and outer blanks."""
    return F.lower(F.trim(F.translate(col, "_", " ")))


def flat_bodies(df: DataFrame, *, row: str = "concept_row", key: str = "concept_key", body: str = "body") -> DataFrame:
    """(row, names, edges, kinds, entity, home): what linkage compares, one row for each record.

    names: folded name forms of key, common name and aliases; edges: folded edge names, each once; kinds: words in
    parentheses of key and common name; entity and home: as stated, or null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for k, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                b = parse(text)
                given = [n for n in [k, *names_of(b)] if is_real(n)]
                names = set().union(*map(name_forms, given)) if given else set()
                notes, web = b.get("notes"), b.get("web_sites")
                entity = notes.get("entity") if isinstance(notes, dict) else None
                home = web.get("home_page") if isinstance(web, dict) else None
                kinds = set().union(*map(kinds_in, [x for x in (k, b.get("common_name")) if isinstance(x, str)])) if given else set()
                for col, x in zip(cols, (sorted(names), sorted({f for e in edge_names(b) if (f := fold(e))}), sorted(kinds), entity if is_real(entity) else None, home.strip().lower() if is_real(home) else None)):
                    col.append(x)
            ls = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (ls, ls, ls, pa.string(), pa.string())))], names=["row", "names", "edges", "kinds", "entity", "home"])

    return df.select(F.col(row).cast("long").alias("row"), F.col(key).alias("key"), F.col(body).alias("body")).filter("row is not null").mapInArrow(run, "row long, names array<string>, edges array<string>, kinds array<string>, entity string, home string")


def _mark(texts: list[str]) -> int:
    """The same number for texts that are equal but for case, accents, signs, blanks and their order."""
    folded = "\x01".join(sorted(fold(t) or t for t in texts))
    return int.from_bytes(hashlib.blake2b(folded.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def body_values(df: DataFrame, *, row: str = "concept_row", body: str = "body") -> DataFrame:
    """(row, field, size, value) for every field with a real value: letters of the name, letters of the texts, number of edges, and a number for the value itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fields, sizes, values = [], [], [], []
            for r, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = parse(text)
                name = b.get("common_name")
                name, texts, edges = [name] if is_real(name) else [], description_texts(b), edge_names(b)
                for field, size, value in (("common_name", sum(len(n.strip()) for n in name), name), ("descriptions", sum(map(len, texts)), texts), ("edges", len(edges), edges)):
                    if size:
                        rows.append(r)
                        fields.append(field)
                        sizes.append(size)
                        values.append(_mark(value))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(fields, pa.string()), pa.array(sizes, pa.int64()), pa.array(values, pa.int64())], names=["row", "field", "size", "value"])

    return df.select(F.col(row).cast("long").alias("row"), F.col(body).alias("body")).filter("row is not null and body is not null").mapInArrow(run, "row long, field string, size long, value long")
