"""Remove long strings that occur more than once, by sorting sampled suffixes.

Of every window of ``length`` bytes one place inside is sampled: the least hash of 16 bytes among
its first ``spread`` places.  Equal windows have the same sample at the same place, so windows need
only be compared within a group of samples whose next bytes (at least length - spread + 1) agree.  A
sample with the text around it that its windows cover is a segment.  Equal segments have all
their windows twice.  The other segments of a group are sorted by the bytes from the sample on (deep-shallow
sorting); common prefixes with neighbours in that order and common suffixes of the bytes before
the sample give the windows that two segments share.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import checkpointed, sliced
from rillet.llm.shingles import mixed
from rillet.llm.suffix_sort import common_prefix, deep_shallow_order

GRAM = 16


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a repeated string.  spread: places that a sample is chosen from.
    chunk: window starts handled at a time.  group: segments sorted in one task; the windows of a
    larger group are counted by their hashes instead, which any number of tasks share."""

    length: int = 400
    spread: int = 320
    chunk: int = 1 << 18
    group: int = 2000

    @property
    def shared(self) -> int:
        """Bytes from a sample on that all its windows have."""
        return self.length - self.spread + 1


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


@lru_cache(maxsize=4)
def _tables(size: int) -> list[tuple]:
    """For two hash functions: a number per byte, the powers of a base and of its inverse."""
    rng = np.random.default_rng(11)
    made = []
    for _ in range(2):
        values = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 1 << 62)) * 4 + 3
        made.append((values, _powers(base, size), _powers(pow(base, -1, 1 << 64), size)))
    return made


class Hashes:
    """Hashes of all parts of a chunk of bytes, from sums over its beginnings."""

    def __init__(self, data: np.ndarray, size: int):
        self.sums, self.inverse = [], []
        for values, powers, inverse in _tables(size):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
            self.sums.append(sums)
            self.inverse.append(inverse)

    def of(self, starts: np.ndarray, ends: np.ndarray, function: int) -> np.ndarray:
        sums = self.sums[function]
        return mixed((sums[ends] - sums[starts]) * self.inverse[function][starts] + (ends - starts).astype(np.uint64))


def samples(data: np.ndarray, rule: Repeats) -> Iterator[tuple]:
    """(place, before, after, head, one, two) arrays for the segments of a document, by chunks.

    A sample at ``place`` belongs to the windows that start ``before`` to ``after`` bytes before it.
    ``head`` is a hash of the bytes that they all share from it on; one and two hash the segment.
    """
    n_windows = len(data) - rule.length + 1
    size = rule.chunk + 2 * rule.length
    for start in range(0, n_windows, rule.chunk):
        count = min(rule.chunk, n_windows - start)
        part = data[start : start + count + rule.length - 1]
        hashes = Hashes(part, size)
        n_grams = count + rule.spread - 1
        places = np.arange(n_grams)
        grams = mixed(hashes.of(places, places + GRAM, 0))
        # The place in the low bits: of equal grams the first one is the sample.
        grams = (grams & ~np.uint64((1 << 20) - 1)) | places.astype(np.uint64)
        rows = -(-n_grams // rule.spread)
        padded = np.full(rows * rule.spread, np.iinfo(np.uint64).max, np.uint64)
        padded[:n_grams] = grams
        blocks = padded.reshape(rows, rule.spread)
        up_to = np.minimum.accumulate(blocks, axis=1).ravel()
        from_on = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(from_on[:count], up_to[rule.spread - 1 : rule.spread - 1 + count])
        chosen = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        lasts = np.append(firsts[1:] - 1, count - 1)
        place = chosen[firsts]
        ends = lasts + rule.length
        edge = mixed(((place - firsts) * 4096 + (place - lasts)).astype(np.uint64))
        yield (
            place + start, place - firsts, place - lasts, hashes.of(place, place + rule.shared, 0),
            hashes.of(firsts, ends, 0) ^ edge, hashes.of(firsts, ends, 1) ^ edge,
        )


NAMES = ["doc_id", "copy", "place", "before", "after", "head", "one", "two"]


def _segments(rows: DataFrame, rule: Repeats) -> DataFrame:
    """(doc_id, copy, place, before, after, head, one, two) of all documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            waiting, held = [], 0
            for doc_id, copy, text in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "copy", "text")), strict=True):
                for arrays in samples(np.frombuffer(text.encode(), np.uint8), rule):
                    waiting.append((doc_id, copy, arrays))
                    held += len(arrays[0])
                    if held > 100_000:
                        yield joined(waiting)
                        waiting, held = [], 0
            if waiting:
                yield joined(waiting)

    def joined(waiting) -> pa.RecordBatch:
        counts = [len(arrays[0]) for *_, arrays in waiting]
        owner = np.repeat(np.arange(len(waiting)), counts)
        columns = [pa.array([x[n] for x in waiting], pa.int64()).take(pa.array(owner)) for n in (0, 1)]
        for n in range(6):
            column = np.concatenate([arrays[n] for *_, arrays in waiting])
            columns.append(pa.array(column.view(np.int64)))
        return pa.RecordBatch.from_arrays(columns, NAMES)

    schema = ", ".join(f"{name} long" for name in NAMES)
    return rows.select("doc_id", "copy", "text").mapInArrow(cut, schema)


def shared_windows(befores: list[bytes], afters: list[bytes], length: int, depth: int) -> list[list[tuple[int, int]]]:
    """For each segment the ranges of distances (start to sample) of windows that others have too.

    ``befores`` are the bytes up to the sample, ``afters`` those from it on, which all share ``depth`` bytes.
    """
    count = len(afters)
    found: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    order = deep_shallow_order(afters, depth)
    common = [common_prefix(afters[a], afters[b], depth) for a, b in zip(order, order[1:])]  # noqa: B905
    backwards = [before[::-1] for before in befores]
    waiting = [(0, count)]
    while waiting:
        first, last = waiting.pop()
        if last - first < 2:
            continue
        least = min(common[first : last - 1])
        # All of these agree in ``least`` bytes from the sample on: enough for windows that start
        # at least so far before it, if the bytes before it agree as well.
        near = max(0, length - least)
        by_before = deep_shallow_order([backwards[n] for n in order[first:last]])
        members = [order[first + n] for n in by_before]
        agree = [0, *(common_prefix(backwards[a], backwards[b]) for a, b in zip(members, members[1:])), 0]  # noqa: B905
        for n, member in enumerate(members):
            far = max(agree[n], agree[n + 1])
            if far >= near:
                found[member].append((near, far))
        start = first
        for n in range(first, last):
            if n == last - 1 or common[n] == least:
                waiting.append((start, n + 1))
                start = n + 1
    return found


def _by_sorting(bodies: DataFrame, rule: Repeats) -> DataFrame:
    """(head, one, two, near, far): window ranges from sorting each group of segments.

    One range for each segment.  Its windows start less than ``length`` bytes apart, so those that others
    have too cover all bytes from the first one's start to the last one's end.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in sliced(batches):
            out = []
            for row in batch.to_pylist():
                if held and held[0]["head"] != row["head"]:
                    out.extend(ranges(held))
                    held = []
                held.append(row)
            yield table(out)
        if held:
            yield table(ranges(held))

    def ranges(group: list[dict]) -> list[tuple]:
        found = shared_windows([x["left"] for x in group], [x["right"] for x in group], rule.length, rule.shared)
        out = []
        for x, spans in zip(group, found, strict=True):
            spans = [(max(near, x["after"]), far) for near, far in spans if max(near, x["after"]) <= far]
            if spans:
                out.append((x["head"], x["one"], x["two"], min(near for near, _ in spans), max(far for _, far in spans)))
        return out

    def table(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["head", "one", "two", "near", "far"])

    dealt = bodies.repartition("head").sortWithinPartitions("head")
    return dealt.select("head", "one", "two", "after", "left", "right").mapInArrow(solve, "head long, one long, two long, near long, far long")


def _by_counting(bodies: DataFrame, rule: Repeats) -> DataFrame:
    """The same for groups of any size: each window by its hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for row in batch.to_pylist():
                data = np.frombuffer(row["left"] + row["right"], np.uint8)
                starts = np.arange(len(data) - rule.length + 1)
                hashes = Hashes(data, 4 * rule.length)
                columns = [np.full(len(starts), row[name]) for name in ("head", "one", "two")]
                columns += [len(row["left"]) - starts, *(hashes.of(starts, starts + rule.length, n).view(np.int64) for n in (0, 1))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["head", "one", "two", "near", "h", "i"])

    rows = bodies.select("head", "one", "two", "left", "right").mapInArrow(
        windows, "head long, one long, two long, near long, h long, i long"
    )
    twice = rows.groupBy("h", "i").count().filter("count > 1").select("h", "i")
    found = rows.join(twice, ["h", "i"], "left_semi")
    return found.groupBy("head", "one", "two").agg(F.min("near").alias("near"), F.max("near").alias("far"))


def _bodies(open_segments: DataFrame, texts: DataFrame) -> DataFrame:
    """(head, one, two, after, left, right): the bytes of segments given by one of their places.

    A row that repeats an id and text gives a segment twice; it then has copies anyway.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                data = text.encode()
                out = [
                    (x["head"], x["one"], x["two"], x["after"], data[x["place"] - x["before"] : x["place"]], data[x["place"] : x["end"]])
                    for x in parts
                ]
                columns = zip(*out, strict=True)
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["head", "one", "two", "after", "left", "right"]
                )

    part = F.struct("head", "one", "two", "before", "after", "place", "end")
    lists = open_segments.groupBy("doc_id", "copy").agg(F.collect_list(part).alias("parts"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy"))
    joined = texts.join(lists.withColumnsRenamed({"doc_id": "_doc", "copy": "_copy"}), same)
    return joined.select("text", "parts").mapInArrow(cut, "head long, one long, two long, after long, left binary, right binary")


def _repeated_spans(rows: DataFrame, rule: Repeats) -> tuple[DataFrame, DataFrame]:
    """Covered bytes (doc_id, copy, start, end) and the texts of the documents that may have some."""
    heads = _segments(rows, rule).groupBy("head").count().filter("count > 1").select("head")
    segments = checkpointed(_segments(rows, rule).join(heads, "head", "left_semi"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy"))
    some = segments.select(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).distinct()
    texts = checkpointed(rows.join(some, same, "left_semi").select("doc_id", "copy", "text"))

    place = F.struct("doc_id", "copy", "place", "before", "after").alias("at")
    variants = checkpointed(
        segments.select("head", "one", "two", place).groupBy("head", "one", "two").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    )
    groups = variants.groupBy("head").agg(F.count("*").alias("variants")).filter("variants > 1")
    open_segments = variants.join(groups, "head").select(
        "head", "one", "two", "variants", "at.*", (F.col("at.place") - F.col("at.after") + rule.length).alias("end")
    )
    large = F.col("variants") > rule.group
    shared = _by_sorting(_bodies(open_segments.filter(~large), texts), rule)
    if not groups.filter(large).isEmpty():
        shared = shared.union(_by_counting(_bodies(open_segments.filter(large), texts), rule))
    shared = checkpointed(shared)
    whole = variants.filter("n > 1").select("head", "one", "two", F.col("at.after").alias("near"), F.col("at.before").alias("far"))
    spans = segments.join(whole.union(shared), ["head", "one", "two"]).select(
        "doc_id", "copy", (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + rule.length).alias("end")
    )
    return spans, texts


def cut_repeats(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, the bytes removed and the number of runs removed."""
    left, done, removed, runs, run_end = [], 0, 0, 0, -1
    for start, end in sorted(spans):
        if start > run_end:
            runs += 1
            left.append(data[done:start])
        removed += max(0, end - max(start, done))
        done = run_end = max(done, end)
    left.append(data[done:])
    return b"".join(left), removed, runs


def without_repeats(docs: DataFrame, rule: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    A byte of the UTF-8 text is removed if a string of ``rule.length`` bytes around it also starts at any
    other place of any row, the same one included.  ``kept`` is the rest, a binary; null if nothing
    was removed.  A null text counts as empty; repeated rows are copies of each other, with null ids
    too; shorter texts keep all; other columns are not read; an empty table gives an empty result.
    """
    content = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("copy"))
    spans, texts = _repeated_spans(rows, rule)
    lists = spans.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for value, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                kept, removed, runs = cut_repeats(value.encode(), [(x["start"], x["end"]) for x in found])
                out.append((removed, runs, sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("copy"), *(pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True))],
                ["_doc", "_copy", "n_removed", "n_spans", "cut_sha256", "kept"],
            )

    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy"))
    once = texts.join(lists.withColumnsRenamed({"doc_id": "_doc", "copy": "_copy"}), same)
    cuts = once.select("doc_id", "copy", "text", "spans").mapInArrow(
        cut, "_doc long, _copy long, n_removed long, n_spans long, cut_sha256 string, kept binary"
    ).dropDuplicates(["_doc", "_copy"])
    slim = rows.select("doc_id", "copy", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return slim.join(cuts, same, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cut_sha256", "sha").alias("kept_sha256"), "kept",
    )
