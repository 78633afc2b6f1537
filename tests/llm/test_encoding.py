"""Byte-pair encoding, mixing and splitting."""

from __future__ import annotations

import os
import random
from dataclasses import dataclass
from pathlib import Path

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from knotwork.llm import bpe, encoding, mixture, splitting

VOCABULARY = os.environ.get("KNOTWORK_VOCABULARY", bpe.DEFAULT_VOCABULARY)
pytestmark = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(VOCABULARY)


@pytest.fixture(scope="module")
def other():
    """The public library as the other side of the comparison."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(Path(VOCABULARY).with_name("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


TEXTS = ["", "a", "Hello world's end", " \n\n x  y\t", "<|endoftext|>", "東京都は日本の首都である。", "naïve café — 12,345.6", "a" * 700, "🙂" * 90, "\u0000\uffff", "x\r\ny", "abc" * 400 + " end", "퟿ x\u3000y"]


def test_same_ids(coder, other):
    assert coder.encode(TEXTS) == [other(t) for t in TEXTS]
    assert coder.encode([None, ""]) == [[], []] and coder.lengths([None, "", "a b"]) == [0, 0, 2]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_same_ids_for_any_text(coder, other, text):
    assert coder.encode([text]) == [other(text)]


def test_long_words_take_the_same_way(coder, other):
    random.seed(5)
    letters = "".join(random.choice("etaoinshrdlu") for _ in range(10_000))
    for word in (letters, "ab" * 5000, "a" * 10_001, "".join(random.choice("0123456789") for _ in range(2500)), "-" * 5001, "東京都は日本の" * 600):
        assert coder.encode([word]) == [other(word)]


def test_forgetting_words(coder, monkeypatch, other):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    fresh = bpe.Encoder(VOCABULARY)
    for t in ("one two three four", "two five six", "one seven"):
        assert fresh.encode([t, t]) == [other(t)] * 2


def test_corpus(spark, other):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (1, "a b", "x"), (4, "long " * 60_000, "x")], "d long, t string, ids string")
    got = encoding.encode_corpus(df, F.col("d"), F.col("t"), vocabulary=VOCABULARY)
    assert rows(got.filter("d is null or doc_id < 4") if "d" in got.columns else got.filter("doc_id < 4")) == [(1, other("a b")), (1, other("a b")), (2, []), (3, [])]
    assert got.filter("doc_id = 4").select(F.size("ids")).first()[0] == len(other("long " * 60_000))
    assert encoding.encode_corpus(df.limit(0), F.col("d"), F.col("t"), vocabulary=VOCABULARY).count() == 0


# --- mixing


@dataclass
class Budget:
    source: str
    share: float
    max_repeats: int
    available: int = 0
    wanted: float = 0.0
    rounds: int = 0


def budgets_by_hand(available: dict[str, int], targets: list[tuple[str, float, int]], total: float | None = None) -> list[Budget]:
    """The same shares, source by source."""
    merged: dict[str, tuple[float, int]] = {}
    for source, share, repeats in targets:
        if source is not None and share and share > 0 and repeats and repeats > 0:
            old = merged.get(source, (0.0, 0))
            merged[source] = (old[0] + share, max(old[1], repeats))
    all_ = [Budget(s, w, m, available.get(s, 0)) for s, (w, m) in sorted(merged.items())]
    out = [b for b in all_ if b.available > 0]
    if not out:
        return all_
    weight = sum(b.share for b in out)
    limit = {b.source: b.available * b.max_repeats for b in out}
    if total is None:
        total = min(limit[b.source] * weight / b.share for b in out)
    open_, rest = list(out), float(total)
    while open_:
        w = sum(b.share for b in open_)
        full = [b for b in open_ if rest * b.share / w >= limit[b.source]]
        if not full:
            for b in open_:
                b.wanted = rest * b.share / w
            break
        for b in full:
            b.wanted = float(limit[b.source])
        rest -= sum(b.wanted for b in full)
        open_ = [b for b in open_ if b not in full]
    for b in out:
        b.rounds = min(int(b.wanted // b.available), b.max_repeats)
    return all_


def test_budgets(spark):
    have = {"a": 1000, "b": 100, "c": 10}
    available = spark.createDataFrame(list(have.items()), "source string, tokens long")

    def planned(targets, total=None, of=available):
        return {r["source"]: r for r in mixture.plan_budgets(of, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), total).collect()}

    few = [("a", 0.5, 1), ("b", 0.3, 4), (" C", 0.1, 5), ("none", 0.1, 2), (None, 0.2, 1)]
    plan = planned(few)
    assert plan["none"]["wanted"] == 0 and round(plan["c"]["wanted"]) == 50 and plan["c"]["rounds"] == 5 and round(plan["a"]["wanted"]) == 250 and round(plan["b"]["wanted"]) == 150
    wide = {s: r["wanted"] for s, r in planned([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 5)], 800).items()}
    assert wide["c"] == 50 and round(sum(wide.values())) == 800 and round(wide["a"] / wide["b"], 3) == round(0.5 / 0.3, 3)
    assert all(r["wanted"] == 0 for r in planned([("a", 1.0, 1)], of=available.limit(0)).values())
    for total in (None, 1, 100, 700, 1300, 10_000):
        got, by_hand = planned([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 5), ("c", 0.1, 7)], total), budgets_by_hand(have, [("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 5), ("c", 0.1, 7)], total)
        assert all(got[b.source]["rounds"] == b.rounds and abs(got[b.source]["wanted"] - b.wanted) < 1e-6 for b in by_hand)


def mixed(spark, total=None):
    random.seed(4)
    docs = [(i, "word " * random.randrange(1, 20), random.choice(["A", "a ", "a", "b", None, "zz", ""])) for i in range(900)] + [(2000, None, "b"), (2001, "", "b"), (3000, "tail " * 5, " C")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("h", F.lit(1)).withColumn("tokens", F.lit("x"))
    targets = spark.createDataFrame([("A", 0.6, 1), ("b", 0.35, 2), ("c", 0.05, 7), ("none", 0.1, 3)], "source string, target_share double, max_repeats int")
    return mixture.mix_sources(df, F.col("doc_id"), F.col("text"), F.col("source"), targets, total_tokens=total, vocabulary=VOCABULARY)


def test_mixture(spark):
    chosen, report = mixed(spark)
    by = {r["source"]: r for r in report.collect()}
    assert by["none"]["used"] == 0 and abs(by["a"]["actual_share"] - 0.6) < 0.05 and abs(by["b"]["actual_share"] - 0.35) < 0.05 and by["c"]["most_copies"] == 7
    assert all(r["most_copies"] <= r["max_repeats"] for r in by.values()) and chosen.filter("source in ('zz')").count() == 0
    total = sum(r["used"] for r in by.values())
    assert chosen.select(F.sum(F.col("tokens") * F.col("copies"))).first()[0] == total


def test_larger_budgets_take_all_of_smaller_ones(spark):
    small = {r["doc_id"]: r["copies"] for r in mixed(spark, 300)[0].collect()}
    large = {r["doc_id"]: r["copies"] for r in mixed(spark, 2000)[0].collect()}
    assert all(large.get(d, 0) >= c for d, c in small.items()) and sum(large.values()) > sum(small.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_large_records_do_not_keep_a_source_out(spark, seed, monkeypatch):
    """One record in ten is larger than the whole budget of its source; with a tail of few records and with all."""
    random.seed(seed)
    docs = [(i, "word " * (4000 if i % 10 == seed else random.randrange(1, 30)), "ab"[i % 2]) for i in range(600)] + [(9000 + i, "word " * 40, "c") for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    for tail in (60, mixture.TAIL):
        monkeypatch.setattr(mixture._thresholds, "__defaults__", (tail,))
        by = {r["source"]: r for r in mixture.mix_sources(df, F.col("doc_id"), F.col("text"), F.col("source"), targets, vocabulary=VOCABULARY)[1].collect()}
        assert all(abs(r["actual_share"] - r["target_share"]) < 0.02 for r in by.values()), (tail, by)


def test_mixture_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.6, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mix_sources(df, F.col("doc_id"), F.col("text"), F.col("source"), targets, vocabulary=VOCABULARY)
    assert chosen.count() == 0 and [r["used"] for r in report.collect()] == [0]
    assert mixture.mix_sources(df, F.col("doc_id"), F.col("text"), F.col("source"), targets.limit(0), vocabulary=VOCABULARY)[1].count() == 0


# --- splitting


def check(text, pieces, other, limit, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and pieces[-1][3] == "end"
    for s, e, n, _ in pieces:
        assert n == len(other(text[s:e])) <= limit
    for a, b in zip(pieces, pieces[1:]):
        assert a[0] < b[0] <= a[1] < b[1]
        if overlap:
            assert b[0] < a[1]


@pytest.mark.parametrize("text", ["One. " * 900, "Para one is here.\n\n" * 200, "a" * 3000, "東京都は日本の首都。" * 150, "\n" * 500, "word " * 700, "🙂" * 400, "x\r\ny " * 300, "no end here, only clauses, " * 90])
@pytest.mark.parametrize(("limit", "overlap"), [(100, 0), (100, 20), (37, 7)])
def test_split(coder, other, text, limit, overlap):
    check(text, splitting.split_text(text, coder, limit, overlap), other, limit, overlap)


def test_natural_cuts(coder):
    text = ("A sentence of some length is here. " * 5).strip() + "\n\n"
    kinds = {k for *_, k in splitting.split_text(text * 20, coder, 100, 0)}
    assert kinds == {"paragraph", "end"}
    assert splitting.split_text("short", coder) == [(0, 5, 1, "end")] and splitting.split_text("", coder) == [(0, 0, 0, "end")]
    with pytest.raises(ValueError):
        splitting.split_text("x", coder, 10, 5)


def test_dynamic_programme_is_optimal(coder):
    """Against all ways to cut a small text."""
    import itertools

    text = "One two, three. Four five six; seven eight.\nNine ten eleven twelve thirteen. " * 3
    words = coder.cut([text])[0]
    sized = splitting._Sized(words, coder, 24)
    units, kinds = splitting._candidates(sized, 24)
    at, n = sized.tokens[units], len(units)
    even = at[-1] / -(-at[-1] // 24)
    cost = lambda a, b: splitting.PENALTY[splitting.KINDS[kinds[b]]] * (b < n - 1) + splitting.IMBALANCE * ((at[b] - at[a]) / even - 1) ** 2 + 1e-3
    best = min(sum(cost(a, b) for a, b in zip(p, p[1:])) for k in range(5) for c in itertools.combinations(range(1, n - 1), k) for p in [(0, *c, n - 1)] if all(at[b] - at[a] <= 24 for a, b in zip(p, p[1:])))
    place = {int(u): i for i, u in enumerate(units)}
    ends = [0, *(place[e] for _, e, _ in splitting._cut(sized, 24, 0))]
    assert abs(sum(cost(a, b) for a, b in zip(ends, ends[1:])) - best) < 1e-9


@pytest.mark.parametrize("overlap_part", [0, 3])
@pytest.mark.parametrize("limit", [8, 20, 50, 400, 2000])
@pytest.mark.parametrize("kind", ["emoji", "letters", "signs", "lines", "mixed"])
def test_every_piece_keeps_to_the_limit(coder, other, kind, limit, overlap_part):
    random.seed(9)
    emoji = "".join(chr(random.randrange(0x1F300, 0x1F64F)) for _ in range(1500))
    letters = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6000))
    signs = "".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(2500))
    text = {"emoji": emoji, "letters": letters, "signs": signs, "lines": "\n" * 3000, "mixed": emoji[:300] + letters[:900] + "\n\n" + signs[:300] + " word" * 200}[kind]
    overlap = limit // overlap_part if overlap_part else 0
    check(text, splitting.split_text(text, coder, limit, overlap), other, limit, overlap)


def test_a_sign_over_the_limit(coder):
    with pytest.raises(ValueError):
        splitting.split_text("\U0001f9ff" * 5, coder, 1, 0)


def test_queue_of_starts_finds_the_least_cost(coder):
    """Against the plain programme over all pairs of boundaries, with overlap."""
    import numpy as np

    random.seed(6)
    words = ["one", " two", ",", " three", ".", " Four", "\n", "\n\n", " fifteen", ";", " sixteenth"]
    for _ in range(40):
        sized = splitting._Sized([random.choice(words) for _ in range(random.randrange(60, 300))], coder, 64)
        limit = random.choice([20, 37, 64])
        overlap = random.choice([0, limit // 7, limit // 3])
        kinds, at = splitting._kinds(sized.marks), sized.tokens
        if at[-1] <= limit:
            continue
        penalty = np.array([splitting.PENALTY[k] for k in splitting.KINDS])[kinds]
        penalty[-1] = 0
        even = at[-1] / -(-at[-1] // (limit - overlap))
        share = lambda a, b: 1e-3 + splitting.IMBALANCE * ((at[b] - at[a]) / even - 1) ** 2
        start = np.maximum(np.minimum(np.searchsorted(at, at - overlap, "right") - 1, np.arange(len(at)) - 1), 0) if overlap else np.arange(len(at))
        cost = np.zeros(len(at))
        for j in range(1, len(at)):
            cost[j] = penalty[j] + min(cost[i] + share(i, j) for i in range(j) if at[j] - at[start[i]] <= limit and (i == 0 or start[i] > 0))
        ends = [0, *(e for _, e, _ in splitting._cut(sized, limit, overlap))]
        assert abs(sum(share(a, b) + penalty[b] for a, b in zip(ends, ends[1:])) - cost[-1]) < 1e-6


def test_documents(spark):
    df = spark.createDataFrame([(1, "word " * 50), (2, None), (3, ""), (1, "word " * 50), (4, "Long text. " * 9000)], "d long, t string").withColumn("pieces", F.lit(0))
    got = splitting.split_documents(df, F.col("d"), F.col("t"), vocabulary=VOCABULARY)
    assert got.filter("doc_id = 1").count() == 2 and got.filter("doc_id = 2").count() == 0 and got.filter("doc_id = 3 and tokens = 0").count() == 1
    long = splitting.with_text(got.filter("doc_id = 4"), df, F.col("d"), F.col("t")).orderBy("piece").collect()
    assert long[0]["text"].startswith("Long text.") and all(r["tokens"] <= 2000 and len(r["text"]) == r["end"] - r["start"] for r in long) and long[-1]["end"] == 99_000
    assert splitting.split_documents(df.limit(0), F.col("d"), F.col("t"), vocabulary=VOCABULARY).count() == 0
