"""Splitting oversized texts at natural boundaries.

Cut positions are chosen by dynamic programming over all boundaries of a text: of all ways to keep every piece under the
limit the one is taken with the least cost, where a cut costs by the kind of its boundary and a piece by how far it is
from an even share. The cost of a piece is convex in its size, so the best start of a piece never moves back as its end
moves on; a queue of starts, each with the size from which it is the best one, gives every boundary its start in
constant time on average, and no boundary has to be left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.bpe import DEFAULT_VOCABULARY, KEPT_WORDS, Encoder, encoder, share, spans

#: Most tokens of a piece, and tokens that it repeats from the piece before.
MAX_TOKENS = 2000
OVERLAP = 100

#: Kinds of boundary with their penalties: start of a paragraph, line, sentence, clause, word, and any character.
PENALTY = {"paragraph": 0.0, "line": 1.0, "sentence": 2.0, "clause": 4.0, "word": 8.0, "character": 32.0}
KINDS = list(PENALTY)
#: Weight of a piece's squared deviation from an even share.
IMBALANCE = 3.0
#: Tokens kept free below the limit, try by try: a piece that is encoded on its own can have other tokens next to its cuts.
ROOMS = (0, 4, 16, 64, 256)

#: Signs at the end of a unit that end a sentence when a blank follows, or always, and signs that end a clause (fixed values).
_STOPS, _WIDE_STOPS, _CLAUSE = ".!?…", "。！？", ",;:–—、，；"
_QUOTES = "\"'”’)]」』）"

PIECES = "doc_id long, piece int, pieces int, start int, end int, tokens int, boundary string"


#: Words of more characters, or of more tokens than an eighth of the limit, are sized, and may be cut, in chunks of so many characters (fewer under a small limit).
LONG_WORD, CHUNK = 64, 32


#: What a unit says about the boundaries at its ends, as bits; line ends are counted above them.
_BLANK, _EMPTY, _STOP, _WIDE, _PAUSE, _LINES = 1, 2, 4, 8, 16, 32


def _marks(unit: str) -> int:
    blank = unit[0].isspace()
    if blank and unit.isspace():
        return _BLANK | _EMPTY | _LINES * len(_LINE_ENDS.findall(unit))
    end = unit.rstrip(_QUOTES)[-1:]
    return (_BLANK if blank else 0) | (_STOP if end and end in _STOPS else _WIDE if end and end in _WIDE_STOPS else _PAUSE if unit[-1] in _CLAUSE else 0)


_LINE_ENDS = regex.compile(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]")


def _units(words: list[str], coder: Encoder, limit: int) -> tuple[list[str], set[str]]:
    """The words with long ones in chunks, and the chunks."""
    chunk, most = max(1, min(CHUNK, limit // 32)), max(1, limit // 8)
    coder.know(set(words))
    long = {w: [w[i : i + chunk] for i in range(0, len(w), chunk)] for w in set(words) if len(w) > LONG_WORD or coder.sizes[w] > most}
    if not long:
        return words, set()
    return [u for w in words for u in long.get(w, (w,))], {u for us in long.values() for u in us}


class _Sized:
    """A text as units (words, or chunks of long words) with the running number of characters and tokens.

    ``known`` are sizes of chunks; without it they are learned here.
    """

    def __init__(self, words: list[str], coder: Encoder, limit: int, known: dict[str, int] | None = None):
        units, chunks = _units(words, coder, limit)
        if known is None:
            known = _chunk_sizes(chunks, coder)
        coder.know(set(words))
        marks = coder.__dict__.setdefault("marks", {})
        if len(marks) > KEPT_WORDS:
            marks.clear()
        for u in set(units):
            if u not in marks:
                marks[u] = _marks(u)
        n = len(units)
        size = coder.sizes.__getitem__ if not chunks else lambda u: known[u] if u in known else coder.sizes[u]
        run = lambda f: np.concatenate([[0], np.cumsum(np.fromiter(map(f, units), "int64", n))])
        self.chars, self.tokens = run(len), run(size)
        self.marks = np.fromiter(map(marks.__getitem__, units), "int64", n)
        self.whole = not chunks

    def ask(self, text: str, start: int, end: int) -> tuple[int, str]:
        """Tokens of a piece (by units) that is encoded on its own: a number, and a text whose tokens are to be added.

        The pattern never looks back, so between word bounds only white space at the end of a piece is cut otherwise than
        in the whole text. In texts with chunks of long words the whole piece is to be encoded.
        """
        if not self.whole:
            return 0, text[self.chars[start] : self.chars[end]]
        j = end
        while j > start and self.marks[j - 1] & _EMPTY:
            j -= 1
        return int(self.tokens[j] - self.tokens[start]), text[self.chars[j] : self.chars[end]]


def _chunk_sizes(chunks: set[str], coder: Encoder) -> dict[str, int]:
    """Tokens of each chunk, which the pattern may cut further; all are learned at once."""
    listed = list(chunks)
    return dict(zip(listed, coder.lengths(listed))) if listed else {}


def _kinds(m: np.ndarray) -> np.ndarray:
    """The kind of the boundary before each unit, and of the end."""
    n = len(m)
    kind = np.full(n + 1, KINDS.index("character"))
    if n < 2:
        return kind
    before, after = m[:-1], m[1:]
    inner = kind[1:-1]
    inner[(after & _BLANK) > 0] = KINDS.index("word")
    inner[(before & _PAUSE) > 0] = KINDS.index("clause")
    inner[((before & _STOP) > 0) & ((after & _BLANK) > 0) | ((before & _WIDE) > 0)] = KINDS.index("sentence")
    # line ends in a run of white space are summed; the boundary is after the run
    lines = np.where(m & _EMPTY, m // _LINES, 0)
    total = np.cumsum(lines)
    start = np.maximum.accumulate(np.where(m & _EMPTY, 0, np.arange(n) + 1))  # the unit after the last word
    run = total - np.where(start > 0, total[start - 1], 0)
    ended = ((before & _EMPTY) > 0) & ~((after & _EMPTY) > 0)
    inner[ended & (run[:-1] == 1)] = KINDS.index("line")
    inner[ended & (run[:-1] > 1)] = KINDS.index("paragraph")
    return kind


def _candidates(sized: _Sized, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit ends at which a piece may end (all of them, whatever the limit), and their kind; the first is 0 and the last the end of the text.

    White space goes with what follows, as a word's tokens hold the blank before it; line ends stay with what is before.
    """
    return np.arange(len(sized.marks) + 1), _kinds(sized.marks)


def split_text(text: str, coder: Encoder, limit: int = MAX_TOKENS, overlap: int = OVERLAP, words: list[str] | None = None) -> list[tuple[int, int, int, str]]:
    """``split_texts`` of one text."""
    return split_texts([text], coder, limit, overlap, None if words is None else [words])[0]


def split_texts(texts: list[str], coder: Encoder, limit: int = MAX_TOKENS, overlap: int = OVERLAP, cut: list[list[str]] | None = None) -> list[list[tuple[int, int, int, str]]]:
    """(start, end, tokens, boundary at the end) of each piece of each text; one piece when a text is within the limit.

    Every piece but the first starts at the nearest boundary that lies at least ``overlap`` tokens before the end of the
    piece before it. ``cut`` are the words of the texts where the coder has cut them already. Pieces hold at most
    ``limit`` tokens, counted when the piece is encoded on its own; where no plan of the programme keeps to that, which
    takes a small limit and signs of many tokens, the text is cut piece by piece by exact counts. A limit that is
    smaller than a single sign raises an error.
    """
    if not 0 <= overlap < limit / 2:
        raise ValueError("the overlap must be under half of the limit")
    cut = coder.cut(texts) if cut is None else cut
    totals = [sum(map(coder.sizes.__getitem__, words)) for words in cut]
    out: list[list[tuple[int, int, int, str]]] = [[(0, len(t), n, "end")] if n <= limit else [] for t, n in zip(texts, totals)]
    over = [i for i, n in enumerate(totals) if n > limit]
    known = _chunk_sizes(set().union(*(_units(cut[i], coder, limit)[1] for i in over)), coder)
    sized = {i: _Sized(cut[i], coder, limit, known) for i in over}
    for room in ROOMS:
        plans = {i: _cut(sized[i], limit - min(room, limit // 3), overlap) for i in over}
        asked = [(i, *sized[i].ask(texts[i], s, e)) for i, plan in plans.items() for s, e, _ in plan]
        more = iter(coder.lengths([t for *_, t in asked]))
        counts: dict[int, list[int]] = {i: [] for i in over}
        for i, n, _ in asked:
            counts[i].append(n + next(more))
        for i, plan in plans.items():
            if max(counts[i]) <= limit:
                chars = sized[i].chars
                out[i] = [(int(chars[s]), int(chars[e]), n, k) for (s, e, k), n in zip(plan, counts[i])]
        over = [i for i in over if not out[i]]
        if not over:
            break
    for i in over:
        out[i] = _cut_by_counts(texts[i], coder, limit, overlap)
    return out


def _cut(sized: _Sized, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(first unit, unit after the last, boundary at the end) of each piece."""
    kinds = _kinds(sized.marks)
    tokens = sized.tokens
    n = len(tokens)
    # where the next piece starts when one ends at each place: the last place at least ``overlap`` tokens before
    back = np.searchsorted(tokens, tokens - overlap, "right") - 1
    back = np.maximum(np.minimum(back, np.arange(n) - 1), 0) if overlap else np.arange(n)
    penalty = np.array([PENALTY[k] for k in KINDS])[kinds] + 1e-3
    penalty[-1] = 1e-3
    even = float(tokens[-1]) / max(1, -(-int(tokens[-1]) // (limit - overlap)))
    # in even shares: each place, the size at which a piece from it has its least cost, and the last place it may reach
    x = (tokens / even).tolist()
    best_at = (tokens / even + 1.0).tolist()
    reach = ((tokens[back] + limit) / even).tolist()
    # cost / weight of a piece from i to a place p is level[i] - 2 * p * best_at[i] + p * p, so of two starts the later is the better one beyond one place
    cost = (penalty / IMBALANCE).tolist()
    level = [0.0] * n
    prev = [0] * n
    level[0] = best_at[0] * best_at[0]
    queue, since, head = [0], [-1.0], 0
    starts = (back > 0).tolist()  # a first piece within the overlap would be held by the second
    for j in range(1, n):
        p = x[j]
        while head + 1 < len(queue) and p > since[head + 1]:
            head += 1
        i = queue[head]
        prev[j] = i
        b = best_at[j]
        lv = level[j] = cost[j] + level[i] - 2 * p * best_at[i] + p * p + b * b
        if not starts[j]:
            continue
        while True:
            m = queue[-1]
            turn = (lv - level[m]) / (2 * (b - best_at[m]))
            if len(queue) - 1 > head and turn <= since[-1]:
                queue.pop()
                since.pop()
            else:
                break
        queue.append(j)
        since.append(turn if turn < reach[m] else reach[m])
    ends = []
    j = n - 1
    while j > 0:
        ends.append(j)
        j = prev[j]
    ends.reverse()
    out, before = [], 0
    for j in ends:
        if out and int(back[before]) <= out[-1][0]:  # the next piece starts no later and ends later: it holds this one
            out.pop()
        out.append((int(back[before]) if before else 0, j, "end" if j == n - 1 else KINDS[kinds[j]]))
        before = j
    return out


def _cut_by_counts(text: str, coder: Encoder, limit: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """The same by exact counts, from the left: every piece as long as it may be, cut between any two signs."""
    size = lambda s, e: coder.lengths([text[s:e]])[0]
    out: list[tuple[int, int, int, str]] = []
    start = end = 0
    while end < len(text):
        fits, n = end, 0
        reach = min(len(text), start + 8 * limit)
        while reach > fits:  # tokens do not grow with every sign, so each end is counted as it stands
            n = size(start, reach)
            if n <= limit:
                fits = reach
                break
            reach = min(reach - 1, start + max(1, (reach - start) * limit // n))
        if fits == end:
            if start == end:
                raise ValueError(f"the limit of {limit} tokens is less than one sign")
            start = end  # no room beside the overlap
            continue
        out.append((start, fits, n, "end" if fits == len(text) else "character"))
        end = start = fits
        while end < len(text) and start > out[-1][0] + 1 and (n := size(start, end)) < overlap:
            start = max(out[-1][0] + 1, start - max(1, (overlap - n) // 4))
    return out


def split_documents(df: DataFrame, doc_id: Column, text: Column, *, limit: int = MAX_TOKENS, overlap: int = OVERLAP, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Every document as pieces: doc_id, piece, pieces, start and end (characters), tokens, boundary (kind of the cut at its end).

    Documents within the limit have one piece; null texts none; empty texts one of 0 tokens. Repeated rows come out as
    often as they are given. Texts are split in the task that reads them, whole; they are not shuffled.
    """
    share(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for part in spans(batch, 1):
                texts = part.column(1).to_pylist()
                for d, pieces in zip(part.column(0).to_pylist(), split_texts(texts, coder, limit, overlap)):  # new words of all texts are learned at once
                    for k, (s, e, n, kind) in enumerate(pieces):
                        for col, x in zip(cols, (d, k, len(pieces), s, e, n, kind)):
                            col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=["doc_id", "piece", "pieces", "start", "end", "tokens", "boundary"])

    rows = df.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInArrow(run, PIECES)


def with_text(pieces: DataFrame, df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """The pieces with their text."""
    return pieces.join(df.select(doc_id.cast("long").alias("doc_id"), text.alias("_text")), "doc_id").withColumn("text", F.expr("substring(_text, start + 1, end - start)")).drop("_text")
