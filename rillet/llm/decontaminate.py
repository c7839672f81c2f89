"""Find benchmark items inside documents: SimHash of item-sized windows, then exact similarity.

A window of a document has as many words as the item it is compared with.  Windows and items get a 64-bit
SimHash of their words.  A multi-index finds every item within the Hamming radius of a window: of
two fingerprints that differ in at most ``radius`` bits, one of the blocks differs in at most
``radius // blocks`` bits, and for each block the index lists the items under all values that near.
Candidates are confirmed by the exact similarity of their five-word shingles, weighted by how often
each occurs.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rillet.llm.shingles import run_hashes, word_hashes


@dataclass(frozen=True)
class Search:
    """percent: least similarity in percent.  radius, blocks: of the fingerprint search.
    items: items in one index, which bounds its size; more items make more passes.
    stretch: words fingerprinted at a time, which bounds the memory for a long document; none are across a gap
        of more than ``gap`` words between windows."""

    percent: int = 75
    shingle: int = 5
    radius: int = 19
    blocks: int = 4
    items: int = 2000
    stretch: int = 8192
    gap: int = 64


def fingerprints(words: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of each run of ``width`` words: bit i is set if most words have bit i."""
    bits = ((words[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32) * 2 - 1
    sums = np.zeros((len(words) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(sums[width:] - sums[:-width] > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)


def near_values(radius: int, bits: int) -> np.ndarray:
    """All numbers of so many bits with at most ``radius`` of them set."""
    return np.array(
        [sum(1 << place for place in places) for n in range(radius + 1) for places in combinations(range(bits), n)],
        np.uint64,
    )


class ItemsOfSize:
    """The multi-index of the items with the same number of words."""

    def __init__(self, size: int, numbers: list[int], prints: np.ndarray, search: Search):
        self.size, self.numbers, self.prints, self.search = size, np.array(numbers), prints, search
        self.bits = 64 // search.blocks
        near = near_values(search.radius // search.blocks, self.bits)
        self.tables = []
        for block in range(search.blocks):
            values = (self.block(prints, block)[:, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order].astype(np.uint32), np.repeat(np.arange(len(numbers)), len(near))[order]))

    def block(self, prints: np.ndarray, block: int) -> np.ndarray:
        return (prints >> np.uint64(block * self.bits)) & np.uint64((1 << self.bits) - 1)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius; items as numbers of the index."""
        found = []
        for block, (values, items) in enumerate(self.tables):
            wanted = self.block(prints, block).astype(np.uint32)
            first, last = np.searchsorted(values, wanted, "left"), np.searchsorted(values, wanted, "right")
            counts = last - first
            windows = np.repeat(np.arange(len(prints)), counts)
            places = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
            found.append(windows * len(self.numbers) + items[places])
        pairs = np.unique(np.concatenate(found))
        windows, items = pairs // len(self.numbers), pairs % len(self.numbers)
        near = np.bitwise_count(prints[windows] ^ self.prints[items]) <= self.search.radius
        return windows[near], self.numbers[items[near]]


class Index:
    """Items of a benchmark: (id, text) rows without nulls."""

    def __init__(self, rows: list[tuple], search: Search):
        self.search = search
        self.ids, self.shingles, sizes = [], [], {}
        for item, text in rows:
            words = word_hashes(text, marks=True)[0]
            if len(words):
                sizes.setdefault(len(words), []).append((len(self.ids), fingerprints(words, len(words))[0]))
                self.ids.append(item)
                self.shingles.append(self.counts(words))
        self.sizes = [
            ItemsOfSize(size, [n for n, _ in found], np.array([x for _, x in found], np.uint64), search)
            for size, found in sorted(sizes.items())
        ]
        self.widths = sorted({min(size, search.shingle) for size in sizes})
        self.known = np.unique(np.concatenate([x[0] for x in self.shingles])) if self.ids else np.empty(0, np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.known >> np.uint64(44)] = True

    def counts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(run_hashes(words, min(len(words), self.search.shingle)), return_counts=True)

    def similarity(self, words: np.ndarray, item: int) -> float:
        """Common over all shingles, each as often as it occurs."""
        shingles, counts = self.shingles[item]
        own, times = self.counts(words)
        _, left, right = np.intersect1d(shingles, own, assume_unique=True, return_indices=True)
        common = int(np.minimum(counts[left], times[right]).sum())
        return common / (int(counts.sum()) + int(times.sum()) - common)

    def _holds_known(self, words: np.ndarray, width: int) -> np.ndarray:
        """Whether the run of words from each place is a shingle of some item."""
        runs = run_hashes(words, width)
        found = self.maybe[runs >> np.uint64(44)]
        places = np.flatnonzero(found)
        nearest = np.minimum(np.searchsorted(self.known, runs[places]), len(self.known) - 1)
        found[places] = self.known[nearest] == runs[places]
        return found

    def matches(self, text: str) -> list[tuple]:
        """(item, similarity, first word, words) of the best window for each item found."""
        words = word_hashes(text, marks=True)[0]
        # A window without a shingle of any item has similarity 0 to all of them.
        known = {width: self._holds_known(words, width) for width in self.widths if width <= len(words)}
        if not any(found.any() for found in known.values()):
            return []
        best: dict[int, tuple] = {}
        for items in self.sizes:
            size = min(items.size, len(words))
            width = min(size, self.search.shingle)
            if width not in known:
                continue
            # Of a window's and an item's shingles together so many must be common, so at least so
            # many of the window's must be shingles of some item.
            runs = size - width + 1
            percent = self.search.percent
            least = -(-percent * (runs + items.size - width + 1) // (100 + percent))
            before = np.concatenate([[0], np.cumsum(known[width])])
            starts = np.flatnonzero(before[runs:] - before[:-runs] >= max(1, least))
            for part in self._stretches(starts):
                prints = fingerprints(words[part[0] : part[-1] + size], size)[part - part[0]]
                for window, item in zip(*items.within(prints), strict=True):
                    start = int(part[window])
                    similarity = self.similarity(words[start : start + size], item)
                    if 100 * similarity >= self.search.percent and similarity > best.get(item, (0.0,))[0]:
                        best[int(item)] = (similarity, start, size)
        return [(self.ids[item], *found) for item, found in sorted(best.items())]

    def _stretches(self, starts: np.ndarray) -> list[np.ndarray]:
        """The window starts in parts without long gaps that each cover a bounded number of words."""
        if not len(starts):
            return []
        apart = np.diff(starts) > self.search.gap
        return np.split(starts, np.flatnonzero(apart | (np.diff(starts // self.search.stretch) > 0)) + 1)


def _indexes(items: DataFrame, search: Search) -> list[Index]:
    """Indexes of at most ``search.items`` items each; the items of one index reach the driver."""
    rows = items.select("item_id", "text").filter("text IS NOT NULL")
    blocks = -(-rows.count() // search.items)
    if blocks <= 1:
        return [Index(sorted(map(tuple, rows.collect()), key=repr), search)]
    name = F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit(":"), "text")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(name), F.lit(2 * blocks)))
    parts = (dealt.filter(F.col("block") == block).drop("block") for block in range(2 * blocks))
    return [Index(sorted(map(tuple, part.collect()), key=repr), search) for part in parts]


def leaks(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best window for each item in a document.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case.  A document shorter
    than an item is one window.  Null and empty texts and items without words match nothing; an item
    shorter than five words is one shingle; of equally similar windows the first counts; repeated
    rows of documents or items give repeated rows.  Other columns are not read; empty tables
    give an empty result.
    """
    kinds = ", ".join(
        f"{name} {rows.schema[name].dataType.simpleString()}" for rows, name in ((docs, "doc_id"), (items, "item_id"))
    )
    schema = f"{kinds}, similarity double, first_word long, n_words long"

    def found_by(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, *match)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    if text
                    for match in shared.value.matches(text)
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )

        types = [batch_type(docs, "doc_id"), batch_type(items, "item_id"), pa.float64(), pa.int64(), pa.int64()]
        return docs.select("doc_id", "text").mapInArrow(find, schema)

    return reduce(DataFrame.union, [found_by(index) for index in _indexes(items, search)])


def batch_type(rows: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column, of whatever type it is."""
    return to_arrow_type(rows.schema[name].dataType)


def clean(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; rules as in ``leaks``."""
    rows, place = docs, docs.columns.index("text")

    def passes(index: Index):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                free = [not (text and shared.value.matches(text)) for text in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(free, pa.bool_()))

        return choose

    for index in _indexes(items, search):
        rows = rows.mapInArrow(passes(index), docs.schema)
    return rows
