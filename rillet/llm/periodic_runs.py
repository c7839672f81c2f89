"""Periodic runs of words by internal pattern matching.

The words of some documents are numbered and their suffixes sorted by prefix doubling; each doubling gives
the classes of equal strings of 1, 2, 4, ... words.  A run with period q contains a dyadic block of 8 words
or the largest power of two up to q, and its copy q words later.  So for each block of each level that
occurs elsewhere, the next occurrences in the window of two block lengths behind it are looked up: they are
successors of a place in the block's range of the suffix array, which a wavelet tree finds.  Two
occurrences at most half a block apart begin a progression, the block being periodic itself; it is skipped
to its end, and the ends of the periodic stretches give the candidate period.  A candidate is extended to
both sides by the classes and kept if it is long enough; of periods of one stretch the smallest counts.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunRule:
    """A run has at least ``least`` words and ``times`` periods.  ``chunk``: words handled at a time, but
    a document is not split."""

    least: int = 24
    times: int = 3
    chunk: int = 400_000

    def __post_init__(self):
        if self.times < 3 or self.least < 24:
            raise ValueError("blocks of 8 words find runs of 24 words and three periods or more")


#: Words of the smallest block.
BLOCK = 8


class Suffixes:
    """Suffix array of the words of several documents, and the classes of equal strings at each doubling.

    Strings never cross documents: a suffix that ends within a string length is a class of its own.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``words`` are numbers; ``starts`` and ``ends`` give the document of each place."""
        size = len(words)
        self.starts, self.ends = starts, ends
        self.order = np.lexsort((words, starts))
        key = np.stack([starts[self.order], words[self.order]])
        rank = np.empty(size, np.int64)
        rank[self.order] = self._firsts((key[:, 1:] != key[:, :-1]).any(axis=0), np.arange(size))
        self.ranks = [rank]
        length = 1
        while True:
            slots = self._open_slots(rank)
            if not len(slots):
                break
            places = self.order[slots]
            ahead = places + length
            inside = ahead + length <= self.ends[places]
            # What ends too early is in no class with others; the order among these does not matter.
            second = np.where(inside, rank[np.minimum(ahead, size - 1)], -1 - places)
            sort = np.lexsort((second, rank[places]))
            places, second = places[sort], second[sort]
            first = rank[places]
            self.order[slots] = places
            rank = rank.copy()
            rank[places] = self._firsts((first[1:] != first[:-1]) | (second[1:] != second[:-1]), slots)
            self.ranks.append(rank)
            length *= 2

    @staticmethod
    def _firsts(differs: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """For sorted elements in ``slots`` the slot of the first element of their class."""
        new = np.concatenate([[True], differs])[: len(slots)]
        return slots[np.flatnonzero(new)[np.cumsum(new) - 1]]

    def _open_slots(self, rank: np.ndarray) -> np.ndarray:
        """Slots of classes with more than one place."""
        return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank[self.order]] > 1)

    def class_sizes(self, level: int) -> np.ndarray:
        return np.bincount(self.ranks[level], minlength=len(self.order))

    def forwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from the places ``a`` and ``b`` (of one document, ``a`` first) on."""
        a, b, first = a.copy(), b.copy(), a
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            same = b + (1 << level) <= self.ends[first]
            same[same] = rank[a[same]] == rank[b[same]]
            a += same.astype(np.int64) << level
            b += same.astype(np.int64) << level
        return a - first

    def backwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before the places."""
        a, b, first = a.copy(), b.copy(), a
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, length = self.ranks[level], 1 << level
            same = a - length >= self.starts[first]
            same[same] = rank[a[same] - length] == rank[b[same] - length]
            a -= same.astype(np.int64) << level
            b -= same.astype(np.int64) << level
        return first - a


class WaveletTree:
    """A sequence of numbers below ``limit`` as bit rows, from the highest bit on, zeros sorted before ones."""

    def __init__(self, numbers: np.ndarray, limit: int):
        self.bits = max(1, int(limit - 1).bit_length())
        self.size = len(numbers)
        self.ones = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (numbers >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(ones)]))
            numbers = np.concatenate([numbers[ones == 0], numbers[ones == 1]])

    def successors(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each range [left, right) the smallest number in it that is at least ``least``, or -1."""
        below, l, r = np.zeros(len(left), np.int64), left.copy(), right.copy()  # noqa: E741
        for row, ones in enumerate(self.ones):
            one = (least >> (self.bits - 1 - row)) & 1 == 1
            l1, r1 = ones[l], ones[r]
            l0, r0 = l - l1, r - r1
            zeros = self.size - ones[-1]
            below += np.where(one, r0 - l0, 0)
            l, r = np.where(one, zeros + l1, l0), np.where(one, zeros + r1, r0)  # noqa: E741
        found = (below < right - left) & (least < 1 << self.bits)
        wanted, value = below, np.zeros(len(left), np.int64)
        l, r = left.copy(), right.copy()  # noqa: E741
        for row, ones in enumerate(self.ones):
            l1, r1 = ones[l], ones[r]
            l0, r0 = l - l1, r - r1
            zeros = self.size - ones[-1]
            one = wanted >= r0 - l0
            wanted = np.where(one, wanted - (r0 - l0), wanted)
            value |= one.astype(np.int64) << (self.bits - 1 - row)
            l, r = np.where(one, zeros + l1, l0), np.where(one, zeros + r1, r0)  # noqa: E741
        return np.where(found, value, -1)


def _candidates(suffixes: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) arrays: a string at the place occurs again a period later, for every run of the rule."""
    size = len(suffixes.order)
    smallest = BLOCK.bit_length() - 1
    if len(suffixes.ranks) <= smallest:
        return
    # Only strings of a block's length that occur again are in the tree.
    slots = np.flatnonzero(suffixes.class_sizes(smallest)[suffixes.ranks[smallest][suffixes.order]] > 1)
    tree = WaveletTree(suffixes.order[slots], size)
    slot = np.concatenate([[0], np.cumsum(np.bincount(slots, minlength=size))])
    for level in range(smallest, len(suffixes.ranks)):
        length, rank, sizes = 1 << level, suffixes.ranks[level], suffixes.class_sizes(level)
        blocks = np.arange(size)[(np.arange(size) - suffixes.starts) % length == 0]
        place = blocks[sizes[rank[blocks]] > 1]
        left, right = slot[rank[place]], slot[rank[place] + sizes[rank[place]]]
        at = place
        # The stretch around the block with the period of its progression, once that is known.
        while len(place):
            after = tree.successors(left, right, at + 1)
            good = (after >= 0) & (after - place < 2 * length)
            place, left, right, at, after = place[good], left[good], right[good], at[good], after[good]
            if not len(place):
                break
            yield place, after - place
            step = after - at
            progress = step <= length // 2
            last = after.copy()
            if progress.any():
                block, here, period = place[progress], at[progress], step[progress]
                begin, end = _stretch(suffixes, block, period)
                other_begin, other_end = _stretch(suffixes, here, period)
                for shift in (other_end - end, other_begin - begin):
                    useful = shift > 0
                    yield block[useful], shift[useful]
                last[progress] = here + (other_end - length - here) // period * period
            at = np.maximum(after, last)


def _stretch(suffixes: Suffixes, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around the places with the period."""
    # At the end of a document the period may not fit behind the place.
    inside = np.minimum(place + period, suffixes.ends[place])
    equal = np.zeros(len(place), np.int64)
    fits = place + period < suffixes.ends[place]
    equal[fits] = suffixes.forwards(place[fits], inside[fits])
    before = np.zeros(len(place), np.int64)
    before[fits] = suffixes.backwards(place[fits], inside[fits])
    return place - before, place + period + equal


def find_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: RunRule = RunRule()) -> np.ndarray:
    """Rows (start, length, period) of all runs, sorted; places are those of ``words``."""
    found = [np.empty((0, 3), np.int64)]
    if len(words):
        suffixes = Suffixes(words, starts, ends)
        for place, period in _candidates(suffixes):
            begin, end = _stretch(suffixes, place, period)
            length = end - begin
            good = length >= np.maximum(rule.least, rule.times * period)
            found.append(np.unique(np.stack([begin, length, period], axis=1)[good], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    # Several periods of one stretch are multiples of the smallest.
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _of_texts(texts: list[list[bytes]], rule: RunRule) -> list[np.ndarray]:
    """The runs of each document, by the places in it."""
    numbers: defaultdict = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts])
    words = np.fromiter((numbers[word] for document in texts for word in document), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    runs = find_runs(words, np.repeat(starts, sizes), np.repeat(ends, sizes), rule)
    borders = np.searchsorted(runs[:, 0], np.append(starts, len(words)))
    return [runs[a:b] - [start, 0, 0] for a, b, start in zip(borders[:-1], borders[1:], starts, strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that repeat the first period of a run."""
    if not len(runs):
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    return [words[n] for n in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs and the collapsed text.

    A word is a run of characters other than the six ASCII white-space characters; words differ if their bytes
    do.  A run is a stretch of words with smallest period q (words q apart are equal) that has at least
    ``rule.least`` words and ``rule.times`` * q, and that no neighbouring word extends.  ``runs`` holds
    (start, length, period) in words, by start and then period.  ``collapsed`` has the words joined by one
    space, without those that any run contains after its first period.  A null or empty text has no
    words, no runs and an empty collapsed text.  Rows are independent: repeated rows give equal rows, null
    ids stay; other columns are not read; an empty table gives an empty result.

    A task holds the words of one chunk, or of one document if that is longer.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, held, waiting = batch.column("doc_id"), 0, 0, []
            for value in batch.column("text").to_pylist():
                waiting.append((value or "").encode("utf-8", "surrogatepass").split())
                held += len(waiting[-1])
                if held >= rule.chunk:
                    yield solved(ids.slice(first, len(waiting)), waiting)
                    first, held, waiting = first + len(waiting), 0, []
            yield solved(ids.slice(first), waiting)

    def solved(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _of_texts(texts, rule) if texts else []
        joined = np.concatenate([np.empty((0, 3), np.int64), *runs])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in runs], dtype=np.int64)])
        parts = pa.StructArray.from_arrays([pa.array(joined[:, n]) for n in range(3)], ["start", "length", "period"])
        left = [b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass") for words, found in zip(texts, runs, strict=True)]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(x) for x in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), pa.array(left, pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        search, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def best_run(runs):
    """The run with the greatest length in periods, exactly; of equal ones the first start, then the least period."""
    better = """(best, run) -> CASE WHEN best IS NULL OR CAST(run.length AS DECIMAL(38, 0)) * best.period
        > CAST(best.length AS DECIMAL(38, 0)) * run.period THEN run ELSE best END"""
    return F.expr(f"aggregate({runs}, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), {better})")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic end in a tenth of the texts, chosen and shaped by the CRC-32 of the id.

    With h that number and g = h div 10, a text of n words whose h is a multiple of 10 has each word
    i from a = g mod n on replaced by word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).  The words are
    joined by one space.  Texts without words and rows without id stay as they are.
    """
    planted = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    words = r"CASE WHEN _h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"
    planted = planted.withColumn("_words", F.expr(words))
    planted = planted.withColumn("_a", F.expr("CASE WHEN size(_words) > 0 THEN CAST((_h DIV 10) % size(_words) AS INT) END"))
    planted = planted.withColumn("_p", F.expr("CAST(1 + (size(_words) - _a) DIV (3 + (_h DIV 10) % 8) AS INT)"))
    text = """CASE WHEN _a IS NOT NULL THEN array_join(concat(slice(_words, 1, _a), transform(
        sequence(_a, size(_words) - 1), i -> element_at(_words, _a + (i - _a) % _p + 1))), ' ') ELSE text END"""
    return planted.withColumn("text", F.expr(text)).drop("_h", "_words", "_a", "_p")
