"""Repair of the structure of conversations by least-cost edits.

A conversation is well formed if its roles are an optional system row and then pairs of user and assistant.
Rows are kept, given another role or deleted, and rows with empty text are inserted; the cheapest edits
count, and of these the least in ASCII order.  The least costs from each row on, one for each state of the
pattern, are computed backwards.  Only those at checkpoints, about the square root of the number
of rows apart, are kept; the walk forward computes those of one block again and takes the first letter
that lies on a cheapest way.

A conversation of more rows than a part holds is cut into parts.  The costs through a part, from each
state to each, give the vector at its end without its rows; then each part is solved by itself for
every state it may begin in, and a scan over the parts picks the state it does begin in.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rillet.llm.common import checkpointed, written


@dataclass(frozen=True)
class Costs:
    """Costs of the edits, and ``part``: rows of a conversation that one task keeps in memory."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3
    part: int = 4096


#: States: before the first row, after a system, a user and an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted row or a new role leads to, and the role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a kept row leads to, by its initial.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Adjacent initials that a conversation may have, letters of the edits.
LEGAL = {"su", "ua", "au"}
INFINITE = 1 << 60
COUNTS = ("blank", "duplicate", "truncated", "illegal")
#: Faults of a row by number.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3


def row_class(role: str, fault: int) -> tuple[str, int]:
    """What the edits of a row depend on."""
    return ("", BLANK) if fault in (BLANK, DUPLICATE) else (role[:1], fault)


class Edits:
    """The edits of each class of row, and the least costs."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.known: dict = {}
        self.at_end = [0, 2 * costs.insert, costs.insert, 0]

    def of(self, kind) -> list[list[tuple[str, int, int]]]:
        """For each state the edits (letter, cost, next state) of a row, in ASCII order."""
        if kind not in self.known:
            initial, fault = kind
            extra = self.costs.truncated if fault == TRUNCATED else 0
            edits = [[("D", self.costs.delete, state)] for state in range(4)]
            if fault != BLANK:
                for state, out in enumerate(edits):
                    if state in KEPT.get(initial, {}):
                        out.append(("K", extra, KEPT[initial][state]))
                    out.append(("R", self.costs.rerole + extra, NEXT[state]))
            self.known[kind] = edits
        return self.known[kind]

    def before(self, kind, after: list[int]) -> list[int]:
        """Least costs before a row from those after it; rows may be inserted before it."""
        least = [min([cost + after[state] for _, cost, state in out]) for out in self.of(kind)]
        insert = self.costs.insert
        user, assistant = min(least[USER], insert + least[ASSISTANT]), min(least[ASSISTANT], insert + least[USER])
        return [min(least[START], insert + user), min(least[SYSTEM], insert + user), user, assistant]

    def through(self, kinds: list) -> list[int]:
        """Least costs from each state before the rows to each state after the last, as 16 numbers."""
        columns = []
        for end in range(4):
            vector = [0 if state == end else INFINITE for state in range(4)]
            for kind in reversed(kinds):
                vector = self.before(kind, vector)
            columns.append(vector)
        return [min(INFINITE, columns[end][state]) for state in range(4) for end in range(4)]

    def checkpoints(self, kinds: list, at_end: list[int]) -> tuple[int, list[list[int]]]:
        """The rows of a block, and the vector before the first row of each block."""
        step = max(1, isqrt(len(kinds)))
        vector, kept = at_end, []
        for place in range(len(kinds) - 1, -1, -1):
            vector = self.before(kinds[place], vector)
            if place % step == 0:
                kept.append(vector)
        return step, kept[::-1]

    def walk(self, kinds: list, at_end: list[int], states: list[int], last: bool) -> list[tuple[str, int, int]]:
        """(letters, cost, state after the rows) for each state to begin in.

        ``at_end`` holds the least costs after the rows; after the ``last`` of a conversation, rows are
        inserted up to its end.
        """
        step, kept = self.checkpoints(kinds, at_end)
        walks = [([], state) for state in states]
        for block, first in enumerate(range(0, len(kinds), step)):
            rows = kinds[first : first + step]
            vectors = [kept[block + 1] if block + 1 < len(kept) else at_end]
            for kind in reversed(rows):
                vectors.append(self.before(kind, vectors[-1]))
            vectors.reverse()
            for n, (letters, state) in enumerate(walks):
                for place, kind in enumerate(rows):
                    state = self._row(kind, vectors[place], vectors[place + 1], state, letters)
                walks[n] = (letters, state)
        begin = kept[0] if kept else at_end
        found = []
        for (letters, state), entry in zip(walks, states, strict=True):
            cost = begin[entry] - (0 if last else at_end[state])
            while last and state not in (START, ASSISTANT):
                letters.append("I")
                state = NEXT[state]
            found.append(("".join(letters), cost, state))
        return found

    def _row(self, kind, here: list[int], after: list[int], state: int, letters: list[str]) -> int:
        """Append the letters for the rows inserted before a row and for the row; the state after it."""
        while True:
            tight = {letter: to for letter, cost, to in self.of(kind)[state] if cost + after[to] == here[state]}
            if "D" not in tight and here[state] == self.costs.insert + here[NEXT[state]]:
                letters.append("I")
                state = NEXT[state]
                continue
            letter = min(tight)
            letters.append(letter)
            return tight[letter]


def apply_edits(rows: list[tuple[str, str]], letters: str, state: int) -> list[tuple[str, str]]:
    """The repaired rows (role, text); ``state`` is the one before them."""
    repaired, place = [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            repaired.append((ROLES[state], ""))
            continue
        role, text = rows[place]
        place += 1
        if letter == "K":
            state = KEPT[role[:1]][state]
            repaired.append((role, text))
        elif letter == "R":
            state = NEXT[state]
            repaired.append((ROLES[state], text))
    return repaired


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row; ``seen`` says that an earlier one has the same role and text."""
    written_text = text.rstrip(" \t\n\v\f\r")
    return BLANK if not written_text else DUPLICATE if seen else 0 if written_text[-1] in ".!?" else TRUNCATED


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))  # noqa: B905


_PART = "part long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) for sorted rows."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in (*keys, *names)]
        for row in zip(*columns, strict=True):
            if row[: len(keys)] != key:
                if held:
                    yield key, held
                key, held = row[: len(keys)], []
            held.append(row[len(keys) :])
    if held:
        yield key, held


def _records(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _record(held, schema)
            held = []
    yield _record(held, schema)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(columns, schema, strict=True)], schema=schema)


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _whole(rows: DataFrame, costs: Costs) -> DataFrame:
    """The repair of conversations that fit in a part."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {_PART}"

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits = Edits(costs)

        def solved():
            for (conv,), group in _groups(batches, ["conv_id"], ["role", "text"]):
                seen, faults = set(), []
                for row in group:
                    faults.append(fault_of(row[1], row in seen))
                    seen.add(row)
                kinds = [row_class(role, fault) for (role, _), fault in zip(group, faults, strict=True)]
                ((letters, cost, _),) = edits.walk(kinds, edits.at_end, [START], True)
                counts = [faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)]
                illegal = illegal_pairs([role[:1] for role, _ in group])
                yield (conv, 0, *counts, illegal, cost, letters, _structs(apply_edits(group, letters, START)))

        yield from _records(solved(), arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return dealt.select("conv_id", "role", "text").mapInArrow(solve, schema)


def _structs(rows: list[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in rows]


def _in_parts(rows: DataFrame, costs: Costs) -> DataFrame:
    """The repair of conversations of any length, part by part."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    first = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    rows = rows.withColumn("seen", first > 1)
    # Equal rows stand together, so which of them is the first one is decided by "seen" in the order as well.
    dealt = rows.repartitionByRange("conv_id", *_order(), "seen").sortWithinPartitions("conv_id", *_order(), "seen")
    # Numbers grow with the order, also across partitions, and stay as they are once written.
    rows = checkpointed(dealt.select("conv_id", "role", "text", "seen"))
    # Part 0 is a whole conversation.
    rows = rows.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.expr(f"1 + place DIV {costs.part}"))

    def classes(group):
        faults = [fault_of(text, seen) for _, text, seen in group]
        return faults, [row_class(role, fault) for (role, *_), fault in zip(group, faults, strict=True)]

    def survey(batches):
        edits = Edits(costs)

        def found():
            for (conv, part), group in _groups(batches, ["conv_id", "part"], ["role", "text", "seen"]):
                faults, kinds = classes(group)
                initials = [role[:1] for role, *_ in group]
                counts = [faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)]
                yield (conv, part, *counts, illegal_pairs(initials), initials[0], initials[-1], edits.through(kinds))

        yield from _records(found(), survey_arrow)

    survey_kind = f"conv_id {kind}, part long, blank long, duplicate long, truncated long, illegal long, first string, last string, through array<long>"
    survey_arrow = to_arrow_schema(StructType.fromDDL(survey_kind))
    parts = written(rows.select("conv_id", "part", "role", "text", "seen").mapInArrow(survey, survey_kind))

    def backwards(batches):
        def found():
            at_end, last, conv = None, True, None
            for batch in batches:
                for row in batch.to_pylist():
                    if at_end is None or row["conv_id"] != conv:
                        at_end, last, conv = Edits(costs).at_end, True, row["conv_id"]
                    yield conv, row["part"], at_end, last
                    costs_through = np.array(row["through"]).reshape(4, 4)
                    at_end, last = (costs_through + np.array(at_end)).min(axis=1).tolist(), False

        yield from _records(found(), ends_arrow)

    ends_kind = f"conv_id {kind}, part long, at_end array<long>, last boolean"
    ends_arrow = to_arrow_schema(StructType.fromDDL(ends_kind))
    ordered = parts.select("conv_id", "part", "through").repartition("conv_id")
    ends = written(ordered.sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(backwards, ends_kind))

    def walks(batches):
        edits = Edits(costs)

        def found():
            names = ["role", "text", "seen", "at_end", "last"]
            for (conv, part), group in _groups(batches, ["_conv", "_part"], names):
                *_, at_end, last = group[0]
                _, kinds = classes([row[:3] for row in group])
                solved = edits.walk(kinds, at_end, list(range(4)), last)
                yield conv, part, *([x[n] for x in solved] for n in range(3))

        yield from _records(found(), walks_arrow, 16)

    walks_kind = f"conv_id {kind}, part long, audits array<string>, costs array<long>, states array<long>"
    walks_arrow = to_arrow_schema(StructType.fromDDL(walks_kind))
    with_ends = _joined(rows, ends).select("_conv", "_part", "place", "role", "text", "seen", "at_end", "last")
    solved = written(
        with_ends.repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "place").mapInArrow(walks, walks_kind)
    )

    def forwards(batches):
        def found():
            state, conv, before, begun = START, None, "", False
            for batch in batches:
                for row in batch.to_pylist():
                    if not begun or row["conv_id"] != conv:
                        state, conv, before, begun = START, row["conv_id"], None, True
                    border = 0 if before is None else illegal_pairs([before, row["first"]])
                    yield (
                        conv, row["part"], row["blank"], row["duplicate"], row["truncated"], row["illegal"] + border,
                        row["costs"][state], row["audits"][state], state,
                    )
                    state, before = row["states"][state], row["last"]

        yield from _records(found(), plan_arrow, 16)

    plan_kind = f"conv_id {kind}, part long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, state long"
    plan_arrow = to_arrow_schema(StructType.fromDDL(plan_kind))
    both = _joined(solved, parts.drop("through")).drop("conv_id", "part").withColumnsRenamed({"_conv": "conv_id", "_part": "part"})
    plan = written(both.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(forwards, plan_kind))

    def repair(batches):
        def found():
            names = ["role", "text", *COUNTS, "cost", "audit", "state"]
            for (conv, part), group in _groups(batches, ["_conv", "_part"], names):
                *numbers, audit, state = group[0][2:]
                yield conv, part, *numbers, audit, _structs(apply_edits([row[:2] for row in group], audit, state))

        yield from _records(found(), repaired_arrow, 16)

    repaired_kind = f"conv_id {kind}, {_PART}"
    repaired_arrow = to_arrow_schema(StructType.fromDDL(repaired_kind))
    planned = _joined(rows, plan).select("_conv", "_part", "place", "role", "text", *COUNTS, "cost", "audit", "state")
    return planned.repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "place").mapInArrow(repair, repaired_kind)


def _joined(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with what ``parts`` says of their conversation and part; its keys are _conv and _part then."""
    parts = parts.withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    return rows.join(parts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Parts of repaired conversations: conv_id, part, blank, duplicate, truncated, illegal, cost, audit, repaired.

    ``rows`` has conv_id, turn, role and text.  A conversation of up to ``costs.part`` rows is one part,
    number 0; a longer one has several, in the order of their numbers.  Counts and costs of the parts add
    up; audits and repaired rows follow each other.

    The rows of a conversation are taken by turn, nulls first, then role and text, by bytes.  A null role or text
    counts as one space; a null conv_id is a conversation like others.  Each row's first fault counts: blank
    (nothing but ASCII white space), duplicate (an earlier row has its role and text), truncated (its last
    other character is none of . ! ?).  ``illegal`` counts adjacent initials other than su, ua and au.  Edits are
    K keep, R other role (user or assistant), D delete, which blank and duplicate rows must be, and I insert.
    A role with another initial than s, u and a, or none, cannot be kept.  Other columns are not read.  An
    empty table gives an empty result.
    """
    whole, cut = _repaired(rows, costs)
    return whole if cut is None else whole.union(cut)


def _repaired(rows: DataFrame, costs: Costs) -> tuple[DataFrame, DataFrame | None]:
    """The repair of the conversations that are one part, and that of the longer ones if there are any."""
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(x), F.lit(" ")).alias(x) for x in ("role", "text")))
    long = rows.groupBy("conv_id").count().filter(F.col("count") > costs.part)
    # A written table has a known size, so it is broadcast if that is small.
    long = written(long.select(F.col("conv_id").alias("_conv")))
    if long.isEmpty():
        return _whole(rows, costs), None
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return _whole(rows.join(long, same, "left_anti"), costs), _in_parts(rows.join(long, same, "left_semi"), costs)


def digests(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """(conv_id, counts, cost, audit, repaired_sha256) per conversation of ``rows``, after its repair.

    The digest is that of all its `role:text`, joined by line feeds.  The parts of one conversation go
    through one task in order, since the digest of a text is made from its start to its end; only one part is in memory.
    """
    whole, cut = (part and _lines(part) for part in _repaired(rows, costs))
    whole = whole.selectExpr("conv_id", *COUNTS, "cost", "audit", "sha2(coalesce(lines, ''), 256) AS repaired_sha256")
    return whole if cut is None else whole.union(_streamed_digests(cut))


def _lines(parts: DataFrame) -> DataFrame:
    lines = "CASE WHEN size(repaired) > 0 THEN array_join(transform(repaired, x -> concat(x.role, ':', x.text)), '\\n') END AS lines"
    return parts.selectExpr("conv_id", "part", *COUNTS, "cost", "audit", lines)


def _streamed_digests(parts: DataFrame) -> DataFrame:
    """The digests of conversations in several parts."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            names = [*COUNTS, "cost"]
            conv, numbers, audit, made, empty = None, None, [], sha256(), True
            for batch in batches:
                for row in batch.to_pylist():
                    if numbers is None or row["conv_id"] != conv:
                        if numbers is not None:
                            yield conv, *numbers, "".join(audit), made.hexdigest()
                        conv, numbers, audit, made, empty = row["conv_id"], [0] * len(names), [], sha256(), True
                    numbers = [a + row[name] for a, name in zip(numbers, names, strict=True)]
                    audit.append(row["audit"])
                    if row["lines"] is not None:
                        made.update((("" if empty else "\n") + row["lines"]).encode("utf-8", "surrogatepass"))
                        empty = False
            if numbers is not None:
                yield conv, *numbers, "".join(audit), made.hexdigest()

        yield from _records(found(), arrow)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(digest, schema)


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with the damage that the CRC-32 of `conv_id:turn` says, modulo 20; nulls count as one space there.

    0 drops a row, 1 empties its text, 2 takes its . ! ? away, 3 repeats it, 4 makes its role user.
    """
    fate = F.crc32(F.concat(_key("conv_id"), F.lit(":"), _key("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.select("conv_id", "turn", "role", "text", fate.alias("fate"))
        .filter("fate <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def conversation_report(original: DataFrame, rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation of ``original``: the repair of its ``rows``, and ``gaps`` in their turns.

    gaps is the number of turns between the least and the greatest that no row has; null turns do not
    count.  A conversation without rows has zeros, an empty audit and the digest of an empty text.
    """
    turns = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    found = digests(rows, costs).withColumnRenamed("conv_id", "_conv")
    turns = turns.withColumnRenamed("conv_id", "_turns")
    joined = (
        original.select("conv_id").distinct()
        .join(turns, F.col("conv_id").eqNullSafe(F.col("_turns")), "left")
        .join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    )
    zero = [F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in ("gaps", *COUNTS, "cost")]
    return joined.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )
