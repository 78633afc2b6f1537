"""Byte-level BPE by recursive SQL.

Texts are cut into words by the tokenizer's pattern. The distinct new words of a batch become token-position rows; a
recursive query joins neighbouring tokens to the merge table and contracts the pair of minimum rank of every word until
no pair is left; an ordered aggregation gives the ids of each word. Words are kept for the partition.

A step contracts all places of a word's best pair, from the left and without overlap. That equals one leftmost place a
step: a merged token ranks above its parts, so contracting a pair never makes a pair of the same or a lower rank. Words of
any length take the same way. They are cut first where no token of the vocabulary spans the two bytes at a place: no merge
can cross it, and equal parts are contracted once.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: The pattern of the byte_bpe_50k vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Words kept in memory.
KEPT_WORDS = 400_000
#: Bytes and number of texts that are cut into words at once.
SPAN_BYTES, SPAN_TEXTS = 4 << 20, 5_000
#: Steps of one recursive query. The rows of all its steps are held until it ends, so what is not done then goes on in the next.
STEPS = 24

_CONTRACT = f"""
WITH RECURSIVE step(wid, pos, tok, it) AS (
  SELECT wid, pos, tok, 0 FROM chars
  UNION ALL
  SELECT wid, pos, CASE WHEN joined THEN made ELSE tok END, it + 1 FROM (
    SELECT *, lag(joined, 1, false) OVER w AS eaten FROM (
      SELECT *, coalesce(made = best AND (nth - max(CASE WHEN made = best THEN 0 ELSE nth END) OVER w) % 2 = 1, false) AS joined FROM (
        SELECT *, min(made) OVER (PARTITION BY wid) AS best FROM (
          SELECT p.*, m.made FROM
            (SELECT *, lead(tok) OVER w AS nxt, row_number() OVER w AS nth FROM step WINDOW w AS (PARTITION BY wid ORDER BY pos)) p LEFT JOIN merges m ON p.tok = m.l AND p.nxt = m.r))
      WHERE best IS NOT NULL AND it < {STEPS} WINDOW w AS (PARTITION BY wid ORDER BY pos))
    WINDOW w AS (PARTITION BY wid ORDER BY pos))
  WHERE NOT eaten)
SELECT wid, list(tok ORDER BY pos) AS ids, any_value(it) AS it FROM step JOIN (SELECT wid, max(it) AS it FROM step GROUP BY wid) last USING (wid, it) GROUP BY wid
"""


class Encoder:
    """Ids of texts by a ranked byte-pair vocabulary, without special tokens (their strings are ordinary text)."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY, memory: str = "256MB"):
        with open(vocabulary if os.path.exists(vocabulary) else SparkFiles.get(os.path.basename(vocabulary)), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        self.rank_of = ranks
        self.words: dict[str, list[int]] = {}
        self.sizes: dict[str, int] = {}
        self.find = regex.compile(PATTERN).findall
        self.parts: dict[bytes, list[int]] = {bytes([b]): [i] for b, i in enumerate(self.bytes)}
        #: Whether some token holds the two bytes side by side.
        self.spanned = np.zeros((256, 256), bool)
        for token in ranks:
            for a, b in zip(token, token[1:]):
                self.spanned[a, b] = True
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        left, right, made = zip(*self._merges())
        self.db.register("given", pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "made": pa.array(made, pa.int32())}))
        self.db.execute("CREATE TABLE merges AS SELECT l, r, made FROM given")
        self.db.unregister("given")

    def _merges(self) -> Iterable[tuple[int, int, int]]:
        """The pair that each token of two bytes and more is made of: what is left of it when all lower ranks are applied."""
        rank_of = self.rank_of
        for token, rank in rank_of.items():
            n = len(token)
            if n == 2:
                yield rank_of[token[:1]], rank_of[token[1:]], rank
            elif n > 2:
                cuts = [(a, b) for i in range(1, n) if (a := rank_of.get(token[:i], rank)) < rank and (b := rank_of.get(token[i:], rank)) < rank]
                if len(cuts) == 1:
                    yield *cuts[0], rank
                    continue
                parts = [token[i : i + 1] for i in range(n)]
                while len(parts) > 2:
                    k = min((r, i) for i in range(len(parts) - 1) if (r := self.rank_of.get(parts[i] + parts[i + 1], rank)) < rank)[1]
                    parts[k : k + 2] = [parts[k] + parts[k + 1]]
                yield self.rank_of[parts[0]], self.rank_of[parts[1]], rank

    def _learn(self, words: set[str]) -> None:
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        blob = b"".join(raws)
        signs = np.frombuffer(blob, "uint8")
        cut = np.ones(len(blob) + 1, bool)
        cut[1:-1] = ~self.spanned[signs[:-1], signs[1:]]
        cut[np.cumsum([len(r) for r in raws])] = True
        at = np.flatnonzero(cut).tolist()
        pieces = [blob[a:b] for a, b in zip(at, at[1:])]
        if len(self.parts) > KEPT_WORDS:
            self.parts = {k: v for k, v in self.parts.items() if len(k) == 1}
        self._contract([p for p in set(pieces) if p not in self.parts])
        parts, i = self.parts, 0
        for word, raw in zip(words, raws):
            ids, n = [], 0
            while n < len(raw):
                ids += parts[pieces[i]]
                n += len(pieces[i])
                i += 1
            self.words[word] = ids

    def _contract(self, new: list[bytes]) -> None:
        base = np.array(self.bytes, "int32")
        open_ = {i: base[np.frombuffer(p, "uint8")] for i, p in enumerate(new)}
        while open_:
            sizes = np.fromiter(map(len, open_.values()), "int64", len(open_))
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            self.db.register("chars", pa.table({"wid": np.repeat(np.fromiter(open_, "int32", len(open_)), sizes), "pos": pos.astype("int32"), "tok": np.concatenate(list(open_.values()))}))
            done = self.db.execute(_CONTRACT).fetchall()
            self.db.unregister("chars")
            open_ = {}
            for i, ids, steps in done:
                if steps < STEPS:
                    self.parts[new[i]] = ids
                else:
                    open_[i] = np.array(ids, "int32")

    def cut(self, texts: Iterable[str | None]) -> list[list[str]]:
        """The words of each text; all of them are known afterwards."""
        cut = [self.find(t) if t else [] for t in texts]
        known = self.words
        new = {w for w in set().union(*cut) if w not in known}
        if len(known) + len(new) > KEPT_WORDS:
            known = self.words = {w: known[w] for words in cut for w in words if w in known}
            self.sizes = {w: len(ids) for w, ids in known.items()}
        self.know(new)
        return cut

    def know(self, words: set[str]) -> None:
        """Learn those words of the pattern that are not known."""
        new = {w for w in words if w not in self.words}
        if new:
            self._learn(new)
            self.sizes.update((w, len(self.words[w])) for w in new)

    def encode(self, texts: Iterable[str | None]) -> list[list[int]]:
        """The ids of each text; none for empty and null texts."""
        cut = self.cut(texts)
        known = self.words
        return [[i for w in words for i in known[w]] for words in cut]

    def lengths(self, texts: Iterable[str | None]) -> list[int]:
        """The number of ids of each text."""
        cut = self.cut(texts)
        size = self.sizes.__getitem__
        return [sum(map(size, words)) for words in cut]


def spans(batch: pa.RecordBatch, column: int) -> Iterable[pa.RecordBatch]:
    """A batch in parts whose texts are cut into words at once: many texts, but not too much of them."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (total + n > SPAN_BYTES or i - start >= SPAN_TEXTS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


_shared: set[tuple[str, str]] = set()


def share(spark: SparkSession, vocabulary: str) -> str:
    """Give the vocabulary file to all executors, once; those that do not have its path read the copy."""
    key = (spark.sparkContext.applicationId, vocabulary)
    if key not in _shared:
        spark.sparkContext.addFile(vocabulary)
        _shared.add(key)
    return vocabulary


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str = DEFAULT_VOCABULARY) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
