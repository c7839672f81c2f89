"""The pipeline against plain Python and SQL, stage by stage, on the smallest table."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from rillet.llm.langid import BETWEEN_TEXTS, letters_only, ngram_counts
from rillet.llm.queries import ORACLES
from tests.llm.test_operators import SF, _components

SIZE = 400


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text):
    """Codes of the n-grams of the words of letters, each with a space on both sides."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = f" {' '.join(words)} " if words else ""
    found = [line[n : n + k] for k in (1, 2, 3) for n in range(len(line) - k + 1)]
    return Counter(g for g in found if g != " " and (len(g) < 3 or g[1] != " "))


def ranked(counts):
    def code(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return value

    return sorted(counts, key=lambda gram: (-counts[gram], code(gram)))[:SIZE]


def recognised(docs):
    by_lang = {}
    for row in docs:
        if zlib.crc32(str(row.doc_id).encode()) % 3 != 1 and row.lang is not None and row.text is not None:
            by_lang.setdefault(row.lang, Counter()).update(grams(row.text))
    profiles = {lang: {gram: n for n, gram in enumerate(ranked(counts))} for lang, counts in by_lang.items()}

    def score(text):
        own = ranked(grams(text))
        apart = [sum(abs(p[g] - n) if g in p else SIZE for n, g in enumerate(own)) for p in profiles.values()]
        return 1 - min(apart) / (SIZE * len(own)) if own else 0.0

    return [row for row in docs if score(row.text) >= corpus_pipeline.MIN_LANGUAGE_SCORE]


def different(docs):
    least = {}
    for row in docs:
        least[lowered(row.text)] = min(row.doc_id, least.get(lowered(row.text), row.doc_id))
    return [row for row in docs if least[lowered(row.text)] == row.doc_id]


def apart(docs):
    groups = _components([(row.doc_id, row.text or "") for row in docs])
    return [row for row in docs if groups[row.doc_id][1] == row.doc_id]


def shingles(words, width):
    return Counter(tuple(words[n : n + width]) for n in range(len(words) - width + 1))


def uncontaminated(docs, items):
    word = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")
    benchmark = [words for row in items if (words := word.findall(lowered(row.text)))]

    def holds(words, item):
        size = min(len(words), len(item))
        width = min(5, size)
        wanted = shingles(item, width)
        # Windows without a common shingle have similarity 0.
        if width == 0 or not wanted.keys() & shingles(words, width).keys():
            return False
        for start in range(len(words) - size + 1):
            own = shingles(words[start : start + size], width)
            if 100 * sum((own & wanted).values()) >= 75 * sum((own | wanted).values()):
                return True
        return False

    return [row for row in docs if not any(holds(word.findall(lowered(row.text)), item) for item in benchmark)]


def test_pipeline_agrees_with_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    left = [rows]
    for stage in (recognised, different, apart, lambda docs: uncontaminated(docs, items)):
        left.append(stage(left[-1]))
    # Every stage has something to remove, but for languages: these tables hold few texts without one.
    assert len(left[1]) > len(left[2]) > len(left[3]) > len(left[4]) > 0

    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame([row.asDict() for row in left[-1]]))
    mix = connection.execute(f"SELECT doc_id, size, taken FROM ({ORACLES['op1_mixing']})").fetchall()
    expected = {doc_id: taken // size for doc_id, size, taken in mix if size and taken}

    found = corpus_pipeline.run(spark, SF)
    assert found.columns == [*rows[0].asDict(), "copies"]
    result = found.collect()
    sizes = {doc_id: size for doc_id, size, _ in mix}
    assert {row.doc_id: row.copies for row in result if sizes[row.doc_id]} == expected
    assert len(result) == len({row.doc_id for row in result})
    texts = {row.doc_id: row.text for row in rows}
    assert all(texts[row.doc_id] == row.text for row in result)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs.limit(0), SF)
        assert kept.columns == docs.columns and kept.collect() == []


def test_texts_in_one_batch_share_no_ngram():
    joined = np.concatenate([letters_only("ab"), letters_only("cd")])
    codes, _ = ngram_counts(joined)
    assert BETWEEN_TEXTS not in codes
    assert len(codes) == len(grams("ab") | grams("cd"))
