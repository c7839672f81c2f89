"""Conversation repair against a search of all edits, cheapest and least in ASCII order first."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from rillet.llm.conversations import START, Costs, Edits, conversation_report, damaged, repair, row_class
from rillet.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _next(state, initial):
    pattern = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    return pattern.get((state, initial))


def _search(rows):
    """Counts, illegal pairs, cost, audit and repaired rows of one conversation of (turn, role, text)."""
    seen, faults = set(), []
    for _, role, text in rows:
        marks = [c for c in text if c not in " \t\n\v\f\r"]
        faults.append("b" if not marks else "d" if (role, text) in seen else "" if marks[-1] in ".!?" else "t")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, place, state, out = heapq.heappop(heap)
        if place == len(rows) and state in ("", "a"):
            return [faults.count(x) for x in "bdt"], illegal, cost, audit, out
        if (place, state) in done:
            continue
        done.add((place, state))
        edits = [(3, "I", place, role, (role, "")) for role in ("user", "assistant")]
        if place < len(rows):
            _, role, text = rows[place]
            heapq.heappush(heap, (cost + 4, audit + "D", place + 1, state, out))
            if faults[place] not in ("b", "d"):
                extra = 3 if faults[place] == "t" else 0
                edits.append((extra, "K", place + 1, role, (role, text)))
                edits += [(3 + extra, "R", place + 1, new, (new, text)) for new in ("user", "assistant")]
        for more, letter, to, role, row in edits:
            if _next(state, role[:1]):
                heapq.heappush(heap, (cost + more, audit + letter, to, _next(state, role[:1]), (*out, row)))


def _expected(rows):
    held = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    found = {}
    for conv, left in held.items():
        left.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = {x[0] for x in left if x[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts, illegal, cost, audit, out = _search(left)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
        found[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return found


def _report(rows, costs=None):
    found = conversation_report(rows, damaged(rows), costs or Costs()).select("conv_id", *COLUMNS).collect()
    result = {row[0]: tuple(row)[1:] for row in found}
    assert len(result) == len(found)
    return result


@pytest.fixture(scope="module")
def conversations():
    """Many small conversations with nulls in each column, ties of turns, repeated rows and strange roles."""
    rng = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Hi.", "Hello there", "What?", " ", "", "ok!\n", "no. x", None, "Yes.", "Go on.", "é　", " "]
    rows = []
    for conv in [*range(400), None]:
        for turn in range(rng.randrange(14)):
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), rng.choice(roles), rng.choice(texts)))
    return rows


# A part of three rows cuts all but the shortest conversations.
@pytest.mark.parametrize("part", [4096, 3])
def test_against_search(spark, conversations, part):
    extra = spark.createDataFrame(conversations, ROWS).selectExpr("*", "1 AS part", "'x' AS audit", "2 AS place")
    assert _report(extra, Costs(part=part)) == _expected(conversations)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = {row["conv_id"]: tuple(row[x] for x in COLUMNS) for row in QUERIES["op13_conversations"](spark, folder).collect()}
    assert found == _expected([tuple(row) for row in rows.collect()])


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(8)
    long = [(5, turn, rng.choice(["user", "assistant"]), f"text {turn}" + rng.choice([".", ""])) for turn in range(1500)]
    rows = [*long, *((conv, 0, "user", "Hi.") for conv in range(100, 160))]
    assert _report(spark.createDataFrame(rows, ROWS), Costs(part=100)) == _expected(rows)


def test_empty_table_and_dropped_conversation(spark):
    assert _report(spark.createDataFrame([], ROWS)) == {}
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert _report(spark.createDataFrame([(dropped, 0, "user", "Hi.")], ROWS)) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Why?"), (1, 2, "user", "Why?")], ROWS)
    (row,) = repair(rows).collect()
    assert (row["audit"], row["cost"], row["duplicate"]) == ("IKKDI", 10, 1)
    assert [tuple(x) for x in row["repaired"]] == [("user", ""), ("assistant", "Hi."), ("user", "Why?"), ("assistant", "")]


def test_checkpoints_are_few():
    edits = Edits(Costs())
    kinds = [row_class(role, 0) for role in ("user", "assistant") * 500]
    step, kept = edits.checkpoints(kinds, edits.at_end)
    assert step == 31 and len(kept) == 33
    assert edits.walk(kinds, edits.at_end, [START], True)[0][:2] == ("K" * 1000, 0)
