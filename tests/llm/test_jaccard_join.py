"""Jaccard join against counting all common shingles."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rillet.llm.jaccard_join import JaccardJoin, band_starts, bitmap, folded, similar_classes
from rillet.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def _classes(rows, percent=90, size=3):
    """(n_shingles, component) by id, and the number of links between different sets."""
    sets, holders, by_set = {}, defaultdict(list), defaultdict(list)
    for doc, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = frozenset(tuple(words[n : n + size]) for n in range(max(1, len(words) - size + 1))) if words else frozenset()
        if words:
            by_set[sets[doc]].append(doc)
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    def join(a, b):
        low, high = sorted((root(a), root(b)))
        parent[high] = low

    firsts = {}
    for found, docs in by_set.items():
        firsts[min(docs)] = found
        for doc in docs:
            join(doc, min(docs))
    for doc in sorted(firsts):
        for shingle in firsts[doc]:
            holders[shingle].append(doc)
    common = Counter((a, b) for docs in holders.values() for n, a in enumerate(docs) for b in docs[n + 1 :])
    links = [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(firsts[a]) + len(firsts[b]) - c)]
    for a, b in links:
        join(a, b)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}, len(links)


def _crowd(size, words, changes):
    """Texts with some words of a template changed: pairs are about as often links as not."""
    rng = random.Random(size)
    texts = []
    for n in range(size):
        text = [f"T{k}" for k in range(words)]
        for _ in range(rng.choice(changes)):
            text[rng.randrange(words)] = f"u{n}x{rng.randrange(3)}"
        texts.append((n, " ".join(text)))
    return texts


def _found(frame, rule=None):
    rows = similar_classes(frame, rule or JaccardJoin()).collect()
    return {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows}


# Small pieces and blocks of pairs cut the tiles of the crowd many times.
@pytest.mark.parametrize("rule", [JaccardJoin(), JaccardJoin(piece=7, pairs=50)])
@pytest.mark.parametrize(("words", "changes"), [(200, (1, 2, 3, 4, 5)), (60, (0, 1, 1, 2))])
def test_crowds(spark, rule, words, changes):
    rows = _crowd(250, words, changes)
    expected, links = _classes(rows)
    assert links > 200 and len({c for _, c in expected.values()}) > 20
    assert _found(spark.createDataFrame(rows, DOCS), rule) == expected


def test_other_parameters(spark):
    rows = _crowd(120, 60, (1, 1, 2))
    expected, links = _classes(rows, 75, 5)
    assert links > 20
    assert _found(spark.createDataFrame(rows, DOCS), JaccardJoin(percent=75, shingle=5)) == expected
    with pytest.raises(ValueError):
        JaccardJoin(percent=100)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op11_jaccard_join"](spark, folder)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == _classes(rows)[0]


def test_odd_tables(spark):
    long = " ".join(f"w{n}" for n in range(30_000))
    rows = [
        (1, "One two"), (2, "ONE  two"), (3, None), (4, ""), (5, " \t\n"), (5, " \t\n"), (None, "one two"), (6, "one"),
        (7, long), (8, long + " more"), (9, "a b c d"), (9, "a b c d"), (10, "one two three"),
    ]
    table = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS n", "2 AS id", "3 AS tiles", "4 AS label")
    found = sorted(map(repr, (tuple(row) for row in similar_classes(table).collect())))
    expected = [
        (1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (5, 0, 5), (None, 1, None), (6, 1, 6),
        (7, 29_998, 7), (8, 29_999, 7), (9, 2, 9), (9, 2, 9), (10, 1, 10),
    ]
    assert found == sorted(map(repr, expected))
    assert similar_classes(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("percent", [50, 75, 90, 99])
def test_bands_and_prefixes_lose_nothing(percent):
    rule, starts = JaccardJoin(percent=percent), band_starts(percent)
    for small in range(1, 400):
        for large in range(small, 100 * small // percent + 1):
            low, high = np.searchsorted(starts, [small, large], "right")
            assert high - low in (0, 1)
            need = -(-percent * (small + large) // (100 + percent))
            assert rule.overlap(small + large) == need
            if need <= small:
                assert rule.index(small) >= small - need + 1 and rule.probe(large) >= large - need + 1


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 600, np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 500))) for _ in range(2))
        rows = folded([bitmap(a), bitmap(b)])
        assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= len(np.setxor1d(a, b))
