"""Deeply nested records to flat tables that keep parent and place.

A document becomes an adjacency table: node, parent, label, ordinal, kind and scalar. All nodes of a document lie in
the same Arrow batch, so the joins of object nodes with their children are gathers over the parent column and need no
shuffle. A spec names the collections to pivot into entity tables, whatever shape a collection comes in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of a node.
NULL, SCALAR, OBJECT, ARRAY = 0, 1, 2, 3

ADJACENCY = "row_id long, node int, parent int, label string, ordinal int, kind string, scalar string"
ENTITIES = "row_id long, child string, path string, parent_path string, position int, scalars map<string,string>"


def _constant(name: str):
    raise ValueError(name)


_decode = json.JSONDecoder(parse_constant=_constant).decode


def _parse(text: str | None):
    """The value of a JSON text (a string that again holds JSON is opened); raises ValueError when it is none."""
    value = _decode(text)
    while isinstance(value, str):
        try:
            value = _decode(value)
        except (ValueError, RecursionError):
            break
    return value


def _nodes(texts: list[str | None]) -> tuple[np.ndarray, list[tuple], np.ndarray]:
    """Document of each node, rows (parent, label, ordinal, kind, scalar) and the root of each document (-1: no valid JSON).

    Parents are positions among all nodes of the batch. Of members of one name the last counts.
    """
    rows: list[tuple] = []
    add = rows.append
    starts = np.full(len(texts), -1, "int64")
    sizes = np.zeros(len(texts), "int64")
    for d, text in enumerate(texts):
        if text is None:
            continue
        try:
            root = _parse(text)
        except (ValueError, RecursionError):
            continue
        base = len(rows)
        starts[d] = base
        kind = type(root)
        add((-1, None, 0, OBJECT if kind is dict else ARRAY if kind is list else NULL if root is None else SCALAR, None if kind in (dict, list) else root))
        queue = [(base, root)] if kind is dict or kind is list else []
        for at, value in queue:
            members = value.items() if type(value) is dict else ((None, x) for x in value)
            for ordinal, (label, x) in enumerate(members):
                kind = type(x)
                if kind is dict or kind is list:
                    queue.append((len(rows), x))
                    add((at, label, ordinal, OBJECT if kind is dict else ARRAY, None))
                else:
                    add((at, label, ordinal, NULL if x is None else SCALAR, x))
        sizes[d] = len(rows) - base
    return np.repeat(np.arange(len(texts)), sizes), rows, starts


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


class Nodes:
    """The adjacency table of a batch as arrays, with the look-ups that the pivot needs."""

    def __init__(self, texts: list[str | None]):
        self.doc, rows, self.roots = _nodes(texts)
        parent, label, ordinal, kind, self.scalar = zip(*rows) if rows else ((), (), (), (), ())
        self.parent, self.ordinal, self.kind = np.array(parent, "int64"), np.array(ordinal, "int32"), np.array(kind, "int8")
        self.label = pa.array(label, pa.string())
        coded = self.label.dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        self.code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")
        self.n = len(rows)
        self.members = np.bincount(self.parent[self.parent >= 0], minlength=self.n)
        digit = np.array([x.isdigit() for x in self.names] + [False])
        numbered = np.bincount(self.parent[(self.parent >= 0) & digit[self.code]], minlength=self.n)
        self.numbered = (self.kind == OBJECT) & (self.members > 0) & (numbered == self.members)

    def named(self, label: str, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of that label whose parent is in ``of``, and the place of the parent in ``of``."""
        if label not in self.names or not len(of):
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        place = np.full(self.n, -1, "int64")
        place[of] = np.arange(len(of))
        nodes = np.flatnonzero((self.code == self.names.index(label)) & (self.parent >= 0))
        nodes = nodes[place[self.parent[nodes]] >= 0]
        return nodes, place[self.parent[nodes]]

    def children(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All nodes whose parent is in ``of``, and the place of the parent in ``of``."""
        place = np.full(self.n + 1, -1, "int64")
        place[of] = np.arange(len(of))
        owner = place[self.parent] if self.n else np.zeros(0, "int64")  # parent -1 reads the last place, which is -1
        nodes = np.flatnonzero(owner >= 0)
        return nodes, owner[nodes]

    def elements(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Elements of collection nodes: (element, place of the collection in ``of``, position).

        A collection is an array, an object under the only member 'items', an object numbered by its labels or a
        single value (position 0). Null elements take a position and are left out; empty and null collections have none.
        """
        of = of.copy()
        wrapped, owner = self.named("items", of)
        inner = np.isin(self.kind[wrapped], (OBJECT, ARRAY)) & (self.members[of[owner]] == 1)
        of[owner[inner]] = wrapped[inner]
        many = (self.kind[of] == ARRAY) | self.numbered[of]
        nodes, owner = self.children(of[many])
        owner = np.flatnonzero(many)[owner]
        position = self.ordinal[nodes]
        single = np.flatnonzero(~many & (self.kind[of] != NULL) & ~((self.kind[of] == OBJECT) & (self.members[of] == 0)))
        nodes, owner, position = np.concatenate([nodes, of[single]]), np.concatenate([owner, single]), np.concatenate([position, np.zeros(len(single), "int32")])
        there = self.kind[nodes] != NULL
        return nodes[there], owner[there], position[there]

    def scalars(self, of: np.ndarray) -> pa.Array:
        """A map label -> scalar of each object node in ``of``; other nodes have their own scalar under ''."""
        nodes, owner = self.children(of)
        keep = (self.kind[nodes] == SCALAR) & (self.code[nodes] >= 0)
        nodes, owner = nodes[keep], owner[keep]
        own = np.flatnonzero(self.kind[of] == SCALAR)
        nodes, owner = np.concatenate([nodes, of[own]]), np.concatenate([owner, own])
        order = np.argsort(owner, kind="stable")
        nodes, owner = nodes[order], owner[order]
        is_own = self.kind[of[owner]] == SCALAR
        names = pc.if_else(pa.array(is_own), "", self.label.take(pa.array(nodes)).fill_null(""))
        values = pa.array([_text(self.scalar[i]) for i in nodes.tolist()], pa.string())
        offsets = np.searchsorted(owner, np.arange(len(of) + 1)).astype("int32")
        return pa.MapArray.from_arrays(pa.array(offsets), names, values)


@dataclass
class Found:
    """Entities of one batch: node, its child name, its path and its parent's path."""

    node: np.ndarray
    child: str
    path: pa.Array
    parent: pa.Array
    position: np.ndarray
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, "int64"))


def _join(*parts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*[p.cast(pa.string()) for p in parts], "/")


def _pa(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype("int64"))


def edge_descriptors(t: Nodes) -> list[Found]:
    """descriptor (path: position), snippet (descriptor/n) and ref (descriptor/n) of edge records."""
    roots = t.roots[t.roots >= 0]
    node, _, position = t.elements(roots)
    path = _pa(position).cast(pa.string())
    out = [Found(node, "descriptor", path, pa.array([""] * len(node)), position)]
    held, owner = t.named("snippet", node)
    text, which, n = t.elements(held)
    body, of = t.named("text", text)
    given = t.kind[text] != OBJECT
    given[of[t.kind[body] != NULL]] = True
    out.append(Found(text[given], "snippet", _join(path.take(_pa(owner[which[given]])), _pa(n[given])), path.take(_pa(owner[which[given]])), n[given]))
    refs, of = t.named("refs", text)
    ref, which_refs, n = t.elements(refs)
    up = path.take(_pa(owner[which[of[which_refs]]]))
    out.append(Found(ref, "ref", _join(up, _pa(n)), up, n))
    return out


def concept_bodies(t: Nodes) -> list[Found]:
    """alias (path: position), edge (name), descriptor (name/position) and snippet (name/position/n) of concept documents."""
    roots = t.roots[t.roots >= 0]
    roots = roots[t.kind[roots] == OBJECT]
    held, _ = t.named("aliases", roots)
    alias, _, position = t.elements(held)
    none = lambda n: pa.array([""] * n, pa.string())
    out = [Found(alias, "alias", _pa(position).cast(pa.string()), none(len(alias)), position)]
    held, _ = t.named("edges", roots)
    edge, _ = t.children(held[t.kind[held] == OBJECT])
    edge = edge[t.kind[edge] != NULL]
    name = t.label.take(_pa(edge))
    out.append(Found(edge, "edge", name, none(len(edge)), t.ordinal[edge]))
    held, owner = t.named("descriptors", edge)
    desc, which, position = t.elements(held)
    up = name.take(_pa(owner[which]))
    path = _join(up, _pa(position))
    out.append(Found(desc, "descriptor", path, up, position))
    held, owner = t.named("snippet", desc)
    text, which, n = t.elements(held)
    up = path.take(_pa(owner[which]))
    out.append(Found(text, "snippet", _join(up, _pa(n)), up, n))
    return out


Spec = Callable[[Nodes], list[Found]]


def _batches(batches: Iterator[pa.RecordBatch], once: bool) -> Iterator[tuple[np.ndarray, list]]:
    """Ids and texts; a row id that came before in the partition is left out."""
    seen: set[int] = set()
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        if once:
            keep = [i for i, x in enumerate(ids.tolist()) if not (x in seen or seen.add(x))]
            if len(keep) < len(ids):
                ids, texts = ids[keep], texts.take(pa.array(keep, pa.int64()))
        yield ids, texts.to_pylist()


def _source(df: DataFrame, row_id: Column, body: Column, once: bool) -> DataFrame:
    rows = df.select(row_id.cast("long").alias("row_id"), body.cast("string").alias("body")).filter(F.col("row_id").isNotNull() & F.col("body").isNotNull())
    return rows.repartition("row_id") if once else rows


def adjacency(df: DataFrame, row_id: Column, body: Column, *, once: bool = True) -> DataFrame:
    """The adjacency table of every document: row_id, node (0: the root), parent (-1 of the root), label, ordinal, kind, scalar.

    Null ids, null bodies and bodies that are no valid JSON have no rows. With ``once`` a repeated id counts once.
    """
    kinds = np.array(["null", "scalar", "object", "array"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches, once):
            t = Nodes(texts)
            base = t.roots[t.doc] if t.n else np.zeros(0, "int64")
            parent = np.where(t.parent < 0, -1, t.parent - base)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[t.doc]), pa.array((np.arange(t.n) - base).astype("int32")), pa.array(parent.astype("int32")), t.label, pa.array(t.ordinal), pa.array(kinds[t.kind], pa.string()), pa.array([_text(x) for x in t.scalar], pa.string())],
                names=["row_id", "node", "parent", "label", "ordinal", "kind", "scalar"],
            )

    return _source(df, row_id, body, once).mapInArrow(run, ADJACENCY)


def shred(df: DataFrame, row_id: Column, body: Column, spec: Spec, *, scalars: bool = True, once: bool = True) -> DataFrame:
    """One row for each entity that ``spec`` finds: row_id, child, path, parent_path, position and its scalar members.

    Joined back by (row_id, parent_path) = (row_id, path) the rows give the nesting again. ``scalars`` False leaves
    the map empty. See ``adjacency`` for nulls, invalid bodies and repeated ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches, once):
            t = Nodes(texts)
            for f in spec(t):
                if not len(f.node):
                    continue
                values = t.scalars(f.node) if scalars else pa.MapArray.from_arrays(pa.array(np.zeros(len(f.node) + 1, "int32")), pa.array([], pa.string()), pa.array([], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[t.doc[f.node]]), pa.array([f.child] * len(f.node), pa.string()), f.path.cast(pa.string()), f.parent.cast(pa.string()), pa.array(f.position.astype("int32")), values],
                    names=["row_id", "child", "path", "parent_path", "position", "scalars"],
                )

    return _source(df, row_id, body, once).mapInArrow(run, ENTITIES)


def entity_table(entities: DataFrame, child: str, columns: list[str]) -> DataFrame:
    """The flat table of one kind of entity, with the named scalar members as columns."""
    return entities.filter(F.col("child") == child).select("row_id", "path", "parent_path", "position", *(F.col("scalars")[c].alias(c) for c in columns))
