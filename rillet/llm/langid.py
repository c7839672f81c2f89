"""Language identification by rank-order profiles of character n-grams.

The profile of a language lists the most frequent n-grams (one to three characters, within words) of
its labelled texts.  A document gets the language whose profile is the least out of place: for
each of the document's own most frequent n-grams the difference of the two ranks counts, and the
length of the profile if the language does not have it.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


UNKNOWN = "und"
SPACE = 32
#: Bits that hold one code point.
POINT = 21
#: Two spaces, where one text ends and the next begins: no n-gram of either.
BETWEEN_TEXTS = (SPACE << POINT) | SPACE
#: Characters whose n-grams are counted at a time.
SLICE = 1 << 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(point).isalpha() for point in range(0x110000)])


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-case text: words of letters with one space before and after each."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[len(letter) - np.argmax(letter[::-1])] = True
    return np.where(letter, points, SPACE)[keep].astype(np.int64)


def ngram_counts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the n-grams of one to three characters and how often each occurs.

    A single space is no n-gram, and no n-gram holds a space between letters.
    """
    found = []
    for start in range(0, max(1, len(points)), SLICE):
        part = points[start : start + SLICE + 2]
        own = part[:SLICE]
        pairs = (part[:-1] << POINT) | part[1:]
        triples = (pairs[:-1] << POINT) | part[2:]
        codes = np.concatenate(
            [own[own != SPACE], pairs[:SLICE][pairs[:SLICE] != BETWEEN_TEXTS], triples[part[1:-1] != SPACE][:SLICE]]
        )
        found.append(np.unique(codes, return_counts=True))
    if len(found) == 1:
        return found[0]
    codes, where = np.unique(np.concatenate([codes for codes, _ in found]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([counts for _, counts in found])).astype(np.int64)


def top_ngrams(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, the most frequent first; of equally frequent ones the smaller."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def language_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): how often an n-gram occurs in the texts of a language, from (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                waiting = by_lang.setdefault(lang, [])
                waiting.append(letters_only(text))
                if sum(map(len, waiting)) >= SLICE:
                    yield rows(lang, waiting)
                    by_lang[lang] = []
            for lang, waiting in by_lang.items():
                if waiting:
                    yield rows(lang, waiting)

    def rows(lang: str, waiting: list[np.ndarray]) -> pa.RecordBatch:
        codes, counts = ngram_counts(np.concatenate(waiting))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"]
        )

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Profiles:
    """Ranks of n-grams in the profile of each language, as arrays."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(ranked)
        self.codes = np.unique(np.array([code for codes in ranked.values() for code in codes], np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            places = np.searchsorted(self.codes, np.array(ranked[lang], np.int64))
            self.ranks[places, column] = np.arange(len(places))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a text and 1 minus its distance as a share of the largest possible."""
        points = letters_only(text or "")
        if not self.langs or not len(points):
            return UNKNOWN, 0.0
        own = top_ngrams(*ngram_counts(points), self.size)
        places = np.searchsorted(self.codes, own)
        places[(places == len(self.codes)) | (self.codes[places - (places == len(self.codes))] != own)] = len(self.codes)
        ranks = self.ranks[places]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.langs[best], 1.0 - float(apart[best]) / (self.size * len(own))


def learn(texts: DataFrame, size: int = 400) -> Profiles:
    """Profiles from all rows of (lang, text) without nulls.

    N-grams are counted by Spark; ``size`` rows per language reach the driver.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = language_counts(texts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    ranked: dict[str, list[int]] = {}
    for row in top.select("lang", "gram", "rank").orderBy("lang", "rank").collect():
        ranked.setdefault(row.lang, []).append(row.gram)
    return Profiles(ranked, size)


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text modulo 3 is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def training_texts(docs: DataFrame) -> DataFrame:
    """(lang, text) of the documents to learn from."""
    rows = docs.filter(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.select("lang", "text")


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Only the text decides.  A text that is null or has no letter, and every text if nothing was
    learned, gets ``und`` with score 0.  Of languages equally far the first by code point wins.
    Repeated rows get equal results; other columns are not read; an empty table gives none.
    """
    # The profiles have a fixed number of rows per language.
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def recognised(docs: DataFrame, profiles: Profiles, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    place = docs.columns.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text) for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
