"""Periodic runs against every lag of every text."""

import hashlib
import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pytest

from crowdgrid.llm import periodic_runs
from crowdgrid.llm.common import table
from crowdgrid.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def all_runs(words):
    """Every stretch on every diagonal, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(6, 4 * q):
                found.setdefault((first - q, i), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def answer(doc_id, text):
    words = brute.words(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs, kept = all_runs(words), [True] * n
    for s, length, q in runs:
        kept[s + q : s + length] = [False] * (length - q)
    best = (None,) * 3
    if runs:
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for w, k in zip(words, kept) if k)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, *digests)


COLUMNS = [
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
]


def answers(docs):
    found = periodic_runs.summarise(periodic_runs.find_runs(periodic_runs.planted(docs)))
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def test_runs_of_the_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).select(*COLUMNS).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [r for r in rows if len(brute.words(r.text)) < 2000]
    assert len(short) > 0.9 * len(rows)
    for r in short:
        assert got[r.doc_id] == answer(r.doc_id, r.text)
    assert sum(g[1] for g in got.values()) > 10


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_made_sequences(seed):
    r = random.Random(seed)
    for _ in range(120):
        n, kinds = r.randint(0, 160), r.choice([1, 2, 2, 3, 5, 50])
        words = [r.randrange(kinds) for _ in range(n)]
        for _ in range(r.randint(0, 3)):
            if n > 8:
                a, p = r.randrange(n), r.randint(1, n // 3)
                for i in range(a, min(n, a + r.randint(3, n))):
                    words[i] = words[a + (i - a) % p]
        assert periodic_runs.runs_of(np.array(words, dtype=np.int64)) == all_runs(words)


def test_equal_names_of_different_units_lose_nothing(monkeypatch):
    """All units of a width get one name: every diagonal is a candidate, none is believed."""
    monkeypatch.setattr(periodic_runs, "_names", lambda names, width: names[:-width] * np.uint64(0))
    r = random.Random(3)
    for _ in range(40):
        words = [r.randrange(2) for _ in range(40)] + [0, 1, 2] * r.randint(1, 9)
        got = periodic_runs.runs_of(np.array(words, dtype=np.int64))
        assert set(got) == set(all_runs(words))


@pytest.mark.parametrize("pattern", [[0], [0, 1], [0] * 6 + [1], None, "random"])
def test_long_sequences(pattern):
    n = 1 << 18
    if pattern is None:  # no stretch comes three times in a row
        words = np.array([bin(i).count("1") % 2 for i in range(n)])
        assert periodic_runs.runs_of(words) == []
    elif pattern == "random":
        words = np.random.default_rng(1).integers(0, 2, n)
        assert all(length >= max(6, 4 * q) for _, length, q in periodic_runs.runs_of(words))
    else:
        words = np.resize(np.array(pattern), n)
        got = periodic_runs.runs_of(words)
        assert (0, n, len(pattern)) in got
        assert len(got) == (1 if len(pattern) < 6 else 1 + len(range(0, n - 5, 7)))


def test_odd_texts_ties_and_repeated_rows(spark):
    twice = "a a a a a a " + "b c d " * 3 + "e f " * 5
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a " * 5), (5, "a " * 6), (6, "a " * 6), (6, "a " * 6),
        (7, "x y x y x y x y"), (8, "x y x y x y x"), (9, twice), (None, "n " * 9), (None, None),
        (10, "a a a a a a b a a a a a a"), (11, "           "),
        (12, "A a A a A a A a A"), (13, "\x00 \x00 \x00 \x00 \x00 \x00"), (14, "w" * 100_000),
        (15, "a b " * 40_000 + "c " * 40_000),
    ]
    got = answers(spark.createDataFrame(rows, DOCS))
    quick = [(i, t) for i, t in rows if i != 15]
    assert [g for g in got if g[0] != 15] == sorted((answer(*r) for r in quick), key=str)
    assert [g[1:5] for g in got if g[0] == 15] == [(2, 0, 80_000, 2)]
    tied = [g for g in got if g[0] == 10][0]
    assert tied[1:6] == (2, 0, 6, 1, 6000)


def test_empty_tables_and_clashing_columns(spark):
    assert answers(spark.createDataFrame([], DOCS)) == []
    wide = "doc_id long, text string, runs string, collapsed int, n_words string, start long, _best long"
    rows = [(1, "a a a a a a a", "r", 1, "n", 2, 3)]
    assert answers(spark.createDataFrame(rows, wide)) == [answer(1, "a a a a a a a")]


def test_planted_rows_repeat_to_the_end(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 60))) for i in range(300)]
    got = answers(spark.createDataFrame(rows, DOCS).repartition(7))
    assert got == sorted((answer(*r) for r in rows), key=str)
    assert sum(g[1] for g in got) > 5
