"""Periodic runs against a search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rillet.llm.periodic_runs import RunRule, WaveletTree, collapse, find_runs, periodic_runs
from rillet.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def _search(words, least=24, times=3):
    found = {}
    for period in range(1, len(words) // times + 1):
        place = 0
        while place + period < len(words):
            end = place
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - place + period
            if end > place and length >= max(least, times * period):
                found.setdefault((place, length), period)
            place = max(end, place + 1)
    return sorted((start, length, period) for (start, length), period in found.items())


def _text(rng, kind):
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(200))]
    if kind == 1:
        words = []
        while len(words) < rng.randrange(1, 400):
            part = [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
            words += (part * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        return words
    if kind == 2:
        return ["a"] * rng.randrange(150)
    if kind == 3:
        part = ["a"] * rng.randrange(1, 20) + ["b"] + ["a"] * rng.randrange(20) + ["c"] * rng.randrange(2)
        return (part * rng.randrange(1, 8))[: rng.randrange(1, 300)]
    if kind == 4:
        # Blocks that are periodic themselves inside a longer period: progressions.
        part = ["a"] * rng.randrange(8, 30) + ["b"] * rng.randrange(8, 30) + ["c"]
        return (part * rng.randrange(2, 6) + ["d"] + part * rng.randrange(2, 6)) * rng.randrange(1, 5)
    one, two = ["a"], ["a", "b"]
    while len(two) < rng.randrange(20, 400):
        one, two = two, two + one
    return two


@pytest.mark.parametrize("kind", range(6))
def test_runs(kind):
    rng = random.Random(kind)
    texts = [_text(rng, kind) for _ in range(150)]
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    words = np.array([ord(x) for text in texts for x in text], np.int64)
    found = find_runs(words, np.repeat(starts, sizes), np.repeat(ends, sizes))
    expected = [(s + start, length, period) for text, s in zip(texts, starts, strict=True) for start, length, period in _search(text)]
    assert [tuple(x) for x in found.tolist()] == expected


def test_wavelet_tree():
    rng = np.random.default_rng(5)
    numbers = rng.permutation(200)[:120]
    tree = WaveletTree(numbers, 200)
    left = rng.integers(0, 121, 3000)
    right = np.minimum(120, left + rng.integers(0, 60, 3000))
    least = rng.integers(0, 201, 3000)
    found = tree.successors(left, right, least)
    for a, b, x, y in zip(left, right, least, found, strict=True):
        assert y == min((v for v in numbers[a:b] if v >= x), default=-1)


def test_few_steps_in_long_periodic_text():
    size = 200_000
    found = find_runs(np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, size))
    assert found.tolist() == [[0, size, 1]]


def _report(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    mark, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and mark % 10 == 0 and n:
        a = mark // 10 % n
        p = 1 + (n - a) // (3 + mark // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _search(words)
    drop = {place for start, length, period in runs for place in range(start + period, start + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    numbers = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    left = " ".join(word for place, word in enumerate(words) if place not in drop)
    return (len(runs), *numbers, digest("".join(f"{a},{b},{c}\n" for a, b, c in runs)), digest(left))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {row["doc_id"]: tuple(row[x] for x in names) for row in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    # The search of all periods takes its time for long texts.
    expected = {row.doc_id: _report(row.doc_id, row.text) for row in docs if len(row.text or "") < 12_000}
    assert {x: found[x] for x in expected} == expected and len(found) == len(docs) and len(expected) > 180
    assert sum(x[0] > 0 for x in expected.values()) > 10


def test_odd_tables(spark):
    long = "a b c " * 40_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "x " * 30), (4, "x　y\n" * 24), (5, "X x " * 12), (5, "X x " * 12), (6, long)]
    table = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS runs", "'x' AS collapsed", "2 AS n_words")
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(table).collect()]
    expected = [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 30, [(0, 30, 1)], "x"), (4, 24, [(0, 24, 1)], "x　y"),
        (5, 24, [(0, 24, 2)], "X x"), (5, 24, [(0, 24, 2)], "X x"), (6, 80_000, [(0, 80_000, 2)], "a b c"),
    ]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    assert collapse([b"a"] * 3, np.empty((0, 3), np.int64)) == [b"a"] * 3
    with pytest.raises(ValueError):
        RunRule(times=2)
