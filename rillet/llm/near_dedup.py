"""Near-duplicates by a MinHash LSH forest.

Every distinct shingle set gets one MinHash signature.  A tree of the forest is the list of all
signatures sorted by one order of their values; a document's candidates are its neighbours in the
sorted lists that agree with it in the first values.  In a sparse region all documents with that common
prefix are neighbours.  In a dense one, a crowd, the nearest are looked at first; documents of a crowd that
are then in several groups are joined by their rarest shingles, which finds all their links.  Candidates are
confirmed on their full sets, and documents that links connect form a group.
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
from rillet.llm.shingles import shingle_set


@dataclass(frozen=True)
class Forest:
    """Parameters of the search.

    percent: least Jaccard similarity of a link, in percent.
    shingle: words per shingle.
    trees, prefix: sorted lists, and the values a candidate must share from the start.
        A pair at 75 percent is missed by all 32 lists of prefix 4 with probability 5e-6.
    depth: values that a list is sorted by.
    reach: neighbours looked at in each direction of a list.
    first_trees, first_reach: lists and neighbours of the first round, which joins most of a dense
        region into groups, so that the second need not look at its pairs.
    """

    percent: int = 75
    shingle: int = 5
    trees: int = 32
    prefix: int = 4
    depth: int = 12
    reach: int = 8
    first_trees: int = 8
    first_reach: int = 2

    @property
    def values(self) -> int:
        return self.trees * self.prefix


#: Shingles hashed at a time.
BLOCK = 512
#: Least bits of a parity sketch for each shingle.
SKETCH_BITS = 4
#: Counters for the shingles of crowds: the order of the shingles only has to be about that of their numbers.
COUNTERS = 1 << 20
#: Documents with a common shingle that are compared in one piece, and pairs compared at a time.
PIECE, PAIRS = 4096, 1 << 21


@lru_cache
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash function i is (x XOR flips[i]) * factors[i] modulo 2 ** 64."""
    flips, factors = np.random.default_rng(7).integers(0, 1 << 63, (2, count), np.uint64)
    return flips, (factors << np.uint64(1)) | np.uint64(1)


def signature(shingles: np.ndarray, forest: Forest) -> np.ndarray:
    """16 bits of the least hash value for each of the hash functions."""
    flips, factors = _functions(forest.values)
    least = np.full(forest.values, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK):
        block = shingles[start : start + BLOCK, None] ^ flips
        block *= factors
        np.minimum(least, block.min(axis=0), out=least)
    return ((least >> np.uint64(20)) & np.uint64(0xFFFF)).astype(">u2")


def parities(shingles: np.ndarray) -> bytes:
    """For each remainder of the shingles by a power of two whether an odd number of them has it.

    The sketches of two sets differ in at most as many bits as there are shingles in one set only.
    """
    bits = 64
    while bits < SKETCH_BITS * len(shingles):
        bits *= 2
    counts = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(left: bytes, right: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded to the length of the other."""
    if len(left) < len(right):
        left, right = right, left
    size, folded = len(left), int.from_bytes(left, "little")
    while size > len(right):
        size //= 2
        folded = (folded >> 8 * size) ^ (folded & ((1 << 8 * size) - 1))
    return (folded ^ int.from_bytes(right, "little")).bit_count()


def _signatures(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, n, set_id, signature, parity) per row; set_id is a 128-bit hash of the sorted set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, signs, odd = [], [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, forest.shingle)
                counts.append(len(shingles))
                names.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                signs.append(signature(shingles, forest).tobytes() if len(shingles) else b"")
                odd.append(parities(shingles))
            binary = [pa.array(x, pa.binary()) for x in (names, signs, odd)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), *binary], ["doc_id", "n", "set_id", "signature", "parity"]
            )

    kind = "doc_id long, n long, set_id binary, signature binary, parity binary"
    return docs.select("doc_id", "text").mapInArrow(sign, kind)


def _list_entries(sets: DataFrame, forest: Forest, trees: int) -> DataFrame:
    """(key, id, n, label): an entry of each set in each of the first lists.

    The key is the number of the list and the values in its order.
    """
    order = (np.arange(trees)[:, None] * forest.prefix + np.arange(forest.depth)) % forest.values

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), ">u2").reshape(len(batch), -1)
            keys = np.empty((len(batch), trees, 2 + 2 * forest.depth), np.uint8)
            keys[:, :, :2] = np.arange(trees, dtype=">u2")[:, None].view(np.uint8)
            keys[:, :, 2:] = np.ascontiguousarray(signs[:, order]).view(np.uint8)
            size = keys.shape[2]
            offsets = np.arange(0, keys.size + 1, size, dtype=np.int32)
            column = pa.Array.from_buffers(
                pa.binary(), len(batch) * trees, [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())]
            )
            repeat = lambda name: pa.array(np.repeat(batch.column(name).to_numpy(), trees))
            yield pa.RecordBatch.from_arrays([column, repeat("id"), repeat("n"), repeat("label")], ["key", "id", "n", "label"])

    return sets.select("id", "n", "label", "signature").mapInArrow(entries, "key binary, id long, n long, label long")


class _Neighbours:
    """Pairs of sorted entries at most ``reach`` apart that share the list and the first values.

    Only pairs with different labels: others are known to be in one group.
    """

    def __init__(self, forest: Forest, reach: int, crowds: bool):
        self.forest = forest
        self.reach = reach
        self.crowds = crowds
        self.width = 2 + 2 * forest.prefix

    def pairs(self, keys, ids, sizes, labels, old: int, parts=None):
        """(a, b) of the pairs whose second entry lies at ``old`` or after it.

        With ``parts`` only pairs of entries of different parts.
        """
        run = np.concatenate([[0], np.cumsum((keys[1:, : self.width] != keys[:-1, : self.width]).any(axis=1))])
        found = []
        for apart in range(1, min(self.reach, len(ids) - 1) + 1):
            first = slice(max(0, old - apart), len(ids) - apart)
            second = slice(max(0, old - apart) + apart, len(ids))
            small, large = np.minimum(sizes[first], sizes[second]), np.maximum(sizes[first], sizes[second])
            good = (run[first] == run[second]) & (labels[first] != labels[second]) & (100 * small >= self.forest.percent * large)
            if parts is not None:
                good &= parts[first] != parts[second]
            a, b = ids[first][good], ids[second][good]
            found.append((np.minimum(a, b), np.maximum(a, b)))
        return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 2

    def crowded(self, keys, old: int, parts=None):
        """The places of entries whose run goes on for more than ``reach`` entries before or after them.

        Both ends of every pair of a run that ``pairs`` does not look at are among them.
        """
        apart = self.reach + 1
        if not self.crowds or len(keys) <= apart:
            return np.empty(0, np.int64)
        first = np.arange(max(0, old - apart), len(keys) - apart)
        same = (keys[first, : self.width] == keys[first + apart, : self.width]).all(axis=1)
        if parts is not None:
            same &= parts[first] != parts[first + apart]
        return np.unique(np.concatenate([first[same], first[same] + apart]))


def _candidates(entries: DataFrame, forest: Forest, reach: int, crowds: bool) -> tuple[DataFrame, DataFrame]:
    """(a, b): neighbours in the sorted lists; (run, id, label): entries that have more than these in their run,
    if ``crowds`` asks for them.

    The lists are dealt out by ranges, which splits a region of any density.  Neighbours across the
    border of two parts come from a second step over the first and last entries of all parts.
    """
    edge_size = reach + 1
    near = _Neighbours(forest, reach, crowds)
    width = 2 + 2 * forest.depth
    numbers = ["id", "n", "label"]

    def arrays(batch):
        keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint8).reshape(len(batch), width)
        return keys, *(batch.column(name).to_numpy() for name in numbers)

    blank = np.empty(0, np.int64)
    nothing = (np.empty((0, width), np.uint8), blank, blank, blank)

    def rows(pairs, crowd=nothing, edge=nothing):
        """Pairs, which have no key; entries of crowds with the key of their run; entries at the border of the part."""
        names = [None] * len(pairs[0]) + [key.tobytes() for key in (*crowd[0][:, : near.width], *edge[0])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([pairs[0], crowd[1], edge[1]])),
                pa.array(np.concatenate([pairs[1], crowd[2], edge[2]])),
                pa.array(np.concatenate([np.zeros(len(pairs[0]), np.int64), crowd[3], edge[3]])),
                pa.array(names, pa.binary()),
                pa.array(np.repeat([False, True, False], [len(pairs[0]), len(crowd[1]), len(edge[1])])),
            ],
            ["a", "b", "label", "key", "crowded"],
        )

    def joined(held, new):
        return new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))

    def within(batches):
        held, seen = None, 0
        for batch in batches:
            if not len(batch):
                continue
            new = arrays(batch)
            both = joined(held, new)
            old, head = len(both[1]) - len(batch), max(0, min(edge_size - seen, len(batch)))
            places = near.crowded(both[0], old)
            yield rows(near.pairs(*both, old), tuple(x[places] for x in both), tuple(x[:head] for x in new))
            seen += len(batch)
            held = tuple(x[-edge_size:] for x in both)
        if seen > edge_size:
            rest = min(edge_size, seen - edge_size)
            yield rows([blank] * 2, edge=tuple(x[-rest:] for x in held))

    def across(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            both = joined(held, (*arrays(batch), batch.column("part").to_numpy()))
            old = len(both[1]) - len(batch)
            places = near.crowded(both[0], old, both[4])
            yield rows(near.pairs(*both[:4], old, both[4]), tuple(x[places] for x in both[:4]))
            held = tuple(x[-edge_size:] for x in both)

    kind = "a long, b long, label long, key binary, crowded boolean"
    dealt = entries.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = checkpointed(dealt.mapInArrow(within, kind).withColumn("part", F.spark_partition_id()))
    # At most 2 * edge_size entries per part, however large the parts are.
    borders = found.filter("key IS NOT NULL AND NOT crowded").select("key", F.col("a").alias("id"), F.col("b").alias("n"), "label", "part")
    crossing = checkpointed(borders.repartition(1).sortWithinPartitions("key", "id").mapInArrow(across, kind))
    every = found.drop("part").filter("key IS NULL OR crowded").union(crossing)
    rest = every.filter("crowded").select(F.col("key").alias("run"), F.col("a").alias("id"), "label")
    return every.filter("NOT crowded").select("a", "b").distinct(), rest


def _likely(pairs: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """The pairs without those whose sketches differ in more bits than a link leaves shingles to differ in."""

    def possible(batches):
        for batch in batches:
            numbers = (batch.column(x).to_pylist() for x in ("left", "right", "n"))
            good = [
                (100 + forest.percent) * (n - differing(left, right)) >= 2 * forest.percent * n
                for left, right, n in zip(*numbers, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sketches = sets.select("id", "n", "parity")
    both = (
        pairs.join(sketches.toDF("a", "n_left", "left"), "a").join(sketches.toDF("b", "n_right", "right"), "b")
        .select("a", "b", "left", "right", (F.col("n_left") + F.col("n_right")).alias("n"))
    )
    return both.mapInArrow(possible, "a long, b long")


def _full_sets(docs: DataFrame, sets: DataFrame, ids: DataFrame, forest: Forest) -> DataFrame:
    """(id, shingles): the full set of every id, as the bytes of sorted hashes."""

    def cut(batches):
        for batch in batches:
            found = [shingle_set(text, forest.shingle) for text in batch.column("text").to_pylist()]
            names = [blake2b(x.tobytes(), digest_size=16).digest() for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.binary()), pa.array([x.tobytes() for x in found], pa.large_binary())],
                ["id", "set_id", "shingles"],
            )

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi")
    cut_sets = texts.mapInArrow(cut, "id long, set_id binary, shingles binary")
    # An id may stand on several rows; only the sets that it represents count.
    return cut_sets.join(sets.select("id", "set_id"), ["id", "set_id"], "left_semi").select("id", "shingles")


def _links(pairs: DataFrame, full: DataFrame, forest: Forest) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def compare(batches):
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                merged = np.sort(np.concatenate([left, right]))
                common = int((merged[1:] == merged[:-1]).sum())
                good.append(100 * common >= forest.percent * (len(merged) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(full.toDF("a", "left"), "a").join(full.toDF("b", "right"), "b")
    return both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def near_groups(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links join documents with 100 * common >= percent * union of their shingle sets; component_id is
    the smallest doc_id that links reach.  A document without words (null or empty text) is linked
    with nothing.  A row without id is linked with nothing either and has no component_id; it is
    kept.  Rows that repeat an id with the same words are in one group and both kept.  Other columns are not
    read; an empty table gives an empty result.

    Equal sets are one entry of the lists.  A first round looks at near neighbours in a few lists,
    the second at all neighbours in all lists that are not in one group yet.  So a large group of
    near copies is not compared pair by pair.  A third looks at all pairs of crowds that are in several
    groups then.
    """
    parts = salts(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = checkpointed(
        _signatures(docs, forest).withColumn(
            "salt", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(parts)).cast("int")
        )
    )
    named = signed.filter("n > 0 AND doc_id IS NOT NULL")
    least = {"least": ("min", "doc_id")}
    whole = checkpointed(group_totals(named.select("set_id", "salt", "doc_id"), "set_id", "salt", least))
    member = named.select("doc_id", "set_id", "salt", "n", "signature", "parity").join(whole, ["set_id", "salt"])
    sets = checkpointed(
        member.filter("doc_id = least").select(F.col("doc_id").alias("id"), "set_id", "n", "signature", "parity").dropDuplicates(["id", "set_id"])
    )
    labelled = sets.withColumn("label", F.col("id"))
    first = contracted(_round_links(docs, sets, labelled, forest, forest.first_trees, forest.first_reach, False)[0])
    known = checkpointed(replaced(labelled.drop("parity"), "label", first))
    links, crowds = _round_links(docs, sets, known, forest, forest.trees, forest.reach, True)
    steps = [*first, *contracted(replaced(replaced(links, "a", first), "b", first))]
    members = _open_members(crowds, known, steps)
    if not members.isEmpty():
        links = _crowd_links(docs, sets, members, forest)
        steps += contracted(replaced(replaced(links, "a", steps), "b", steps))
    labels = replaced(whole.withColumnRenamed("least", "component_id"), "component_id", steps)
    return signed.select("doc_id", "n", "set_id", "salt").join(labels, ["set_id", "salt"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _round_links(
    docs: DataFrame, sets: DataFrame, labelled: DataFrame, forest: Forest, trees: int, reach: int, crowds: bool
) -> tuple[DataFrame, DataFrame]:
    """Confirmed links between neighbours in the first lists that have different labels; entries of crowds."""
    candidates, rest = _candidates(_list_entries(labelled, forest, trees), forest, reach, crowds)
    pairs = checkpointed(_likely(candidates, sets, forest))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    full = checkpointed(_full_sets(docs, sets, ids, forest))
    return checkpointed(_links(pairs, full, forest)), rest


def _open_members(crowds: DataFrame, sets: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(id, label): the documents of crowds that are in several groups after the steps."""
    groups = replaced(crowds.select("run", "label").distinct(), "label", steps)
    several = groups.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    ids = crowds.join(several, "run", "left_semi").select("id").distinct()
    return checkpointed(replaced(sets.select("id", "label").distinct().join(ids, "id", "left_semi"), "label", steps))


def _crowd_links(docs: DataFrame, sets: DataFrame, members: DataFrame, forest: Forest) -> DataFrame:
    """All links between members that have different labels.

    The shingles of a set are put into one order for all sets, about rarest first.  The first
    common shingle of two sets stands at places with so many shingles from there on, in both, that the
    link is possible: it is one of the first quarter of a set.  Sets that share such a shingle, at such
    places and with such sizes, are candidates.  Nothing else is left out, so no link is.
    """
    full = checkpointed(_full_sets(docs, sets, members, forest))
    percent = forest.percent

    def count(batches):
        totals = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for shingles in batch.column("shingles").to_pylist():
                np.add.at(totals, np.frombuffer(shingles, np.uint64) % np.uint64(COUNTERS), 1)
        places = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(totals[places])], ["counter", "total"])

    counted = full.select("shingles").mapInArrow(count, "counter long, total long")
    counted = counted.groupBy("counter").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros(COUNTERS, np.int64)
    totals[counted.column("counter").to_numpy()] = counted.column("total").to_numpy()

    def firsts(batches):
        for batch in batches:
            found = []
            numbers = (batch.column(x).to_pylist() for x in ("id", "label", "shingles"))
            for doc, label, shingles in zip(*numbers, strict=True):
                shingles = np.frombuffer(shingles, np.uint64)
                n, often = len(shingles), totals[shingles % np.uint64(COUNTERS)]
                order = np.lexsort((shingles, often))[: n - -(-percent * n // 100) + 1]
                # A shingle that is counted once is in no other set.
                places = np.flatnonzero(often[order] > 1)
                order = order[places]
                same = lambda x, places=places: np.full(len(places), x, np.int64)
                found.append((shingles[order].view(np.int64), same(doc), same(label), same(n), n - places, -(-often[order] // PIECE)))
            columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["shingle", "id", "label", "n", "rest", "pieces"])

    entries = full.join(members, "id").select("id", "label", "shingles").mapInArrow(
        firsts, "shingle long, id long, label long, n long, rest long, pieces long"
    )
    # A frequent shingle is cut into pieces, and each two pieces are compared in a task of their own.
    entries = entries.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    entries = entries.select(
        "shingle", "id", "label", "n", "rest", "piece", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high")
    )
    cell = ["shingle", "low", "high"]

    def within(batches):
        held = None
        names = [*cell, "id", "label", "n", "rest", "piece"]
        for batch in _and_end(batches):
            if batch is not None:
                new = np.stack([batch.column(x).to_numpy() for x in names])
                held = new if held is None else np.concatenate([held, new], axis=1)
            if held is None or not held.shape[1]:
                continue
            starts = np.flatnonzero(np.concatenate([[True], (held[:3, 1:] != held[:3, :-1]).any(axis=0)]))
            # The last cell may go on in the next batch.
            done = held.shape[1] if batch is None else starts[-1]
            ends = np.append(starts[1:], held.shape[1])
            for start, end in zip(starts[starts < done], ends[starts < done], strict=True):
                if end - start > 1:
                    yield from _cell_pairs(held[3:, start:end], held[1, start] != held[2, start], percent)
            held = held[:, done:]

    pairs = (
        entries.repartition(*cell).sortWithinPartitions(*cell, "n", "id").mapInArrow(within, "a long, b long").distinct()
    )
    return checkpointed(_links(checkpointed(_likely(pairs, sets, forest)), full, forest))


def _and_end(batches):
    yield from batches
    yield None


def _cell_pairs(cell: np.ndarray, two: bool, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b): candidates among sets that share a shingle, sorted by size; with ``two`` only of different pieces."""
    ids, labels, n, rest, pieces = cell
    values, counts = np.unique(labels, return_counts=True)
    if len(values) == 1:
        return
    # The size of the other set up to which the shingles from here on suffice.
    most = (100 + percent) * rest // percent - n
    small = most >= n
    # Pairs inside the largest group are not gone through.
    large = labels == values[counts.argmax()]
    for firsts, seconds in ((large, small & ~large), (~large, small)):
        x, y = np.flatnonzero(firsts), np.flatnonzero(seconds)
        low = np.searchsorted(n[y], -(-percent * n[x] // 100))
        high = np.minimum(np.searchsorted(y, x), np.searchsorted(n[y], most[x], "right"))
        spans = np.maximum(0, high - low)
        upto = np.concatenate([[0], np.cumsum(spans)])
        start = 0
        while start < len(x):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] + PAIRS, "right")) - 1)
            left = np.repeat(x[start:end], spans[start:end])
            right = y[np.arange(upto[start], upto[end]) - np.repeat(upto[start:end] - low[start:end], spans[start:end])]
            good = (n[left] <= most[right]) & (labels[left] != labels[right])
            if two:
                good &= pieces[left] != pieces[right]
            a, b = ids[left[good]], ids[right[good]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            start = end


def representatives(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns."""
    stay = near_groups(docs, forest).filter("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(stay.withColumnRenamed("id", "stays"), F.col("id").eqNullSafe(F.col("stays")), "left_semi").select("row.*")
