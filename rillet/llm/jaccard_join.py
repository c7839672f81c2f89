"""Jaccard join of word n-gram sets: size-banded tiles, bitmap signatures, exact intersection.

Sizes are cut into bands so that two similar sets are in one band or in two that follow each other.  The
shingles of a set are put into one order for all sets, about rarest first.  Two similar sets share one of
their first shingles (prefix filter), so a tile holds the sets of a band that have one such shingle, and
as visitors those of the band below.  Inside a tile, sizes, the places of the shingle and the bits
in which two bitmaps differ bound the overlap from above; pairs that can still be similar are compared
shingle by shingle.  Similar sets are linked, and links form classes.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import checkpointed, group_totals, salts
from rillet.llm.components import contracted, replaced
from rillet.llm.shingles import mixed, shingle_set


@dataclass(frozen=True)
class JaccardJoin:
    """percent: least Jaccard similarity of a link.  shingle: words per shingle.
    counters: counters for the numbers of shingles, which need only be about right.
    piece: members of a tile that are compared in one task; pairs: pairs compared at a time."""

    percent: int = 90
    shingle: int = 3
    counters: int = 1 << 18
    piece: int = 4096
    pairs: int = 1 << 18

    def __post_init__(self):
        if not 50 <= self.percent <= 99:
            raise ValueError("percent must be from 50 to 99")

    def probe(self, n):
        """First shingles of a set of ``n`` that it shares one of with any smaller or equal similar set."""
        return n + self.percent * n // -100 + 1

    def index(self, n):
        """First shingles of a set of ``n`` that it shares one of with any larger or equal similar set."""
        return n + 2 * self.percent * n // -(100 + self.percent) + 1

    def overlap(self, total):
        """Common shingles that two sets with so many shingles together need."""
        return -(self.percent * total // -(100 + self.percent))


@lru_cache
def band_starts(percent: int) -> np.ndarray:
    """Least sizes of the bands: a set is similar to sets of its own band and the next ones only."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(100 * starts[-1] // percent + 1)
    return np.array(starts)


def bitmap(shingles: np.ndarray) -> bytes:
    """For each remainder of the shingles by a power of two, at least their number, whether an odd number has it.

    Bitmaps of two sets differ in at most as many bits as there are shingles in one of the sets only.
    """
    bits = 64
    while bits < len(shingles):
        bits *= 2
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """A row of 64-bit words per bitmap; longer ones are folded to the length of the shortest."""
    width = min(len(x) for x in bitmaps) // 8
    rows = np.empty((len(bitmaps), width), np.uint64)
    for size in {len(x) for x in bitmaps}:
        places = [n for n, x in enumerate(bitmaps) if len(x) == size]
        part = np.frombuffer(b"".join(bitmaps[n] for n in places), np.uint64).reshape(len(places), -1, width)
        rows[places] = np.bitwise_xor.reduce(part, axis=1)
    return rows


def _numbers_of_shingles(docs: DataFrame, rule: JaccardJoin) -> np.ndarray:
    """About how many sets have a shingle, by its remainder: a table of fixed size, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(rule.counters, np.int64)
        for batch in batches:
            waiting, held = [], 0
            for text in batch.column("text").to_pylist():
                waiting.append(shingle_set(text, rule.shingle))
                held += len(waiting[-1])
                if held > 1 << 20:
                    totals += counted(waiting)
                    waiting, held = [], 0
            totals += counted(waiting)
        places = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(totals[places])], ["counter", "total"])

    def counted(sets):
        joined = np.concatenate([np.empty(0, np.uint64), *sets])
        return np.bincount((joined % np.uint64(rule.counters)).astype(np.int64), minlength=rule.counters)

    found = docs.select("text").mapInArrow(count, "counter long, total long")
    found = found.groupBy("counter").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros(rule.counters, np.int64)
    totals[found.column("counter").to_numpy()] = found.column("total").to_numpy()
    return totals


def _described(docs: DataFrame, rule: JaccardJoin) -> DataFrame:
    """(doc_id, n, set_id, bitmap, tiles) per row.

    ``tiles`` are the tiles of the set in its own band, in the order of their shingles, and then those
    that it visits in the next band.
    """
    often = docs.sparkSession.sparkContext.broadcast(_numbers_of_shingles(docs, rule))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, starts = often.value, band_starts(rule.percent)
        for batch in batches:
            counts, names, maps, sizes, tiles = [], [], [], [0], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, rule.shingle)
                n = len(shingles)
                counts.append(n)
                names.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                maps.append(bitmap(shingles))
                if n:
                    firsts = np.lexsort((shingles, totals[shingles % np.uint64(rule.counters)]))[: rule.probe(n)]
                    band = np.uint64(np.searchsorted(starts, n, "right"))
                    own = shingles[firsts]
                    tiles.append(mixed(np.concatenate([own + band, own[: rule.index(n)] + band + np.uint64(1)])))
                sizes.append(sizes[-1] + (len(tiles[-1]) if n else 0))
            joined = np.concatenate([np.empty(0, np.uint64), *tiles]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(maps, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(joined)),
                ],
                ["doc_id", "n", "set_id", "bitmap", "tiles"],
            )

    return docs.mapInArrow(describe, "doc_id long, n long, set_id binary, bitmap binary, tiles array<long>")


def _possible(pairs: DataFrame, sets: DataFrame, rule: JaccardJoin) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps leave enough common shingles for a link."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = (batch.column(name).to_pylist() for name in ("left", "right", "n_left", "n_right"))
            for left, right, m, n in zip(*columns, strict=True):
                rows = folded([left, right])
                differing = int(np.bitwise_count(rows[0] ^ rows[1]).sum())
                need = rule.overlap(m + n)
                good.append(need <= min(m, n) and m + n - differing >= 2 * need)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    maps = sets.select("id", "n", "bitmap")
    both = pairs.join(maps.toDF("a", "n_left", "left"), "a").join(maps.toDF("b", "n_right", "right"), "b")
    return both.filter(100 * F.least("n_left", "n_right") >= rule.percent * F.greatest("n_left", "n_right")).mapInArrow(
        bound, "a long, b long"
    )


def _links(docs: DataFrame, sets: DataFrame, pairs: DataFrame, rule: JaccardJoin) -> DataFrame:
    """The pairs (a, b) that are similar enough by their full sets."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text, rule.shingle).tobytes() for text in batch.column("text").to_pylist()]
            names = [blake2b(x, digest_size=16).digest() for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(found, pa.large_binary())], ["id", "set_id", "shingles"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                good.append(100 * common >= rule.percent * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = checkpointed(_possible(pairs, sets, rule))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    full = docs.join(ids, "doc_id", "left_semi").mapInArrow(cut, "id long, set_id binary, shingles binary")
    # An id may stand on several rows; only the sets that it represents count.
    full = checkpointed(full.join(sets.select("id", "set_id"), ["id", "set_id"], "left_semi").select("id", "shingles"))
    both = pairs.join(full.toDF("a", "left"), "a").join(full.toDF("b", "right"), "b")
    return checkpointed(both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long"))


def _members(sets: DataFrame, rule: JaccardJoin) -> DataFrame:
    """(tile, id, n, place, visits, low, high, members) for the tiles with more than one set."""
    entries = sets.select("id", "n", F.posexplode("tiles").alias("place", "tile"))
    tiles = entries.groupBy("tile").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("members"))
    probe = F.col("n") - F.ceil(rule.percent * F.col("n") / 100) + 1
    visits = F.col("place") >= probe
    return entries.join(tiles.filter("low < high"), "tile").select(
        "tile", "id", "n", (F.col("place") - F.when(visits, probe).otherwise(0)).alias("place"), visits.alias("visits"),
        "low", "high", "members",
    )


def _pairs_in_pieces(open_members: DataFrame, sets: DataFrame, rule: JaccardJoin) -> DataFrame:
    """(a, b): all pairs of open tiles with different labels that the bounds leave.

    A large tile is cut into pieces, and each two pieces are compared in a task of their own.
    """
    rows = open_members.withColumn("pieces", F.ceil(F.col("members") / rule.piece).cast("long"))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    cell = ["tile", "first", "second"]
    rows = rows.select(
        "tile", F.least("piece", "other").alias("first"), F.greatest("piece", "other").alias("second"),
        "id", "label", "n", "place", F.col("visits").cast("long").alias("visits"), "piece",
    ).join(sets.select("id", "bitmap"), "id")
    names = ["id", "label", "n", "place", "visits", "piece"]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, numbers, maps = None, [], []
        for batch in batches:
            cells = np.stack([batch.column(x).to_numpy() for x in cell], axis=1)
            if not len(cells):
                continue
            columns = np.stack([batch.column(x).to_numpy() for x in names])
            bitmaps = batch.column("bitmap").to_pylist()
            starts = np.concatenate([[0], np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1, [len(cells)]])
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                if key != tuple(cells[start]):
                    yield from found(key, numbers, maps)
                    key, numbers, maps = tuple(cells[start]), [], []
                numbers.append(columns[:, start:end])
                maps.extend(bitmaps[start:end])
        yield from found(key, numbers, maps)

    def found(key, numbers, maps):
        if len(maps) > 1:
            for a, b in tile_pairs(np.concatenate(numbers, axis=1), maps, key[1] != key[2], rule):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    dealt = rows.repartition(*cell).sortWithinPartitions(*cell, "n", "id")
    return dealt.mapInArrow(within, "a long, b long").distinct()


def tile_pairs(members: np.ndarray, maps: list[bytes], two: bool, rule: JaccardJoin) -> Iterator[tuple]:
    """Ids of the pairs of a tile, sorted by size, that the bounds leave; with ``two`` only of different pieces.

    The rows of ``members`` are id, label, n, place of the shingle, visiting or not, and piece.
    """
    ids, labels, n, place, visits, pieces = members
    values, counts = np.unique(labels, return_counts=True)
    if len(values) == 1:
        return
    bits, rest = folded(maps), n - place
    # Members of the largest class need not be compared with each other.
    rare = np.flatnonzero(labels != values[counts.argmax()])
    is_rare = np.zeros(len(n), bool)
    is_rare[rare] = True
    low = np.searchsorted(n, -(rule.percent * n[rare] // -100))
    high = np.searchsorted(n, 100 * n[rare] // rule.percent, "right")
    upto = np.concatenate([[0], np.cumsum(high - low)])
    start = 0
    while start < len(rare):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + rule.pairs, "right")) - 1)
        left = np.repeat(rare[start:end], (high - low)[start:end])
        right = np.arange(upto[start], upto[end]) - np.repeat(upto[start:end] - low[start:end], (high - low)[start:end])
        start = end
        good = (labels[left] != labels[right]) & ~(is_rare[right] & (right <= left))
        left, right = left[good], right[good]
        small, large = np.minimum(left, right), np.maximum(left, right)
        need = rule.overlap(n[small] + n[large])
        good = (visits[large] == 0) & (place[small] < rule.index(n[small])) & (np.minimum(rest[small], rest[large]) >= need)
        if two:
            good &= pieces[small] != pieces[large]
        small, large, need = small[good], large[good], need[good]
        for at in range(0, len(small), 1 << 14):
            a, b = small[at : at + (1 << 14)], large[at : at + (1 << 14)]
            differing = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            good = n[a] + n[b] - differing >= 2 * need[at : at + (1 << 14)]
            if good.any():
                yield ids[a[good]], ids[b[good]]


def similar_classes(docs: DataFrame, rule: JaccardJoin = JaccardJoin(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id (as long), n_shingles, component_id.

    Two documents link when 100 * common >= percent * union of their sets of distinct shingles;
    component_id is the smallest doc_id that links reach, its own included.  A document without words (null
    or empty text) has an empty set and links with nothing.  A row without id links with nothing and has
    no component_id.  Rows that repeat an id with the same words are in one class; rows that repeat it with
    other words share the node of that id.  Other columns are not read; an empty table gives an empty result.

    Equal sets are one member of the tiles.  A first step compares every member of a tile with the
    smallest and the largest id in it, which joins most of a large class with work in proportion to its
    size.  The second compares all pairs of members that are still in different classes, in bounded
    pieces of tiles.  Both confirm on full sets.  Nothing is dropped but by bounds that no link fails.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = salts(docs.sparkSession)
    salt = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(parts)).cast("int")
    described = checkpointed(_described(docs, rule).withColumn("salt", salt))
    named = described.filter("n > 0 AND doc_id IS NOT NULL")
    whole = checkpointed(group_totals(named.select("set_id", "salt", "doc_id"), "set_id", "salt", {"least": ("min", "doc_id")}))
    sets = named.join(whole, ["set_id", "salt"]).filter("doc_id = least")
    sets = checkpointed(sets.select(F.col("doc_id").alias("id"), "set_id", "n", "bitmap", "tiles").dropDuplicates(["id", "set_id"]))

    members = checkpointed(_members(sets, rule))
    ends = members.select("id", F.explode(F.array("low", "high")).alias("end")).filter("id <> end")
    steps = contracted(_links(docs, sets, ends.select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct(), rule))

    labels = replaced(sets.select("id", F.col("id").alias("label")).distinct(), "label", steps)
    labelled = checkpointed(members.drop("low", "high").join(labels, "id"))
    several = labelled.groupBy("tile").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    open_members = checkpointed(labelled.join(several.select("tile"), "tile", "left_semi"))
    if not open_members.isEmpty():
        links = _links(docs, sets, _pairs_in_pieces(open_members, sets, rule), rule)
        steps = [*steps, *contracted(replaced(replaced(links, "a", steps), "b", steps))]

    classes = replaced(whole.withColumnRenamed("least", "component_id"), "component_id", steps)
    return described.select("doc_id", "n", "set_id", "salt").join(classes, ["set_id", "salt"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
