"""Personal data in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

The field labels the tokens of a line from features of their shapes.  It is trained on the driver from a
small labelled table; executors decode many lines at a time by Viterbi's algorithm in numpy.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the kinds.  A run of digits can only match from its start.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the local class, @ and a domain with a dot; found from the @, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def is_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of what the patterns find, in order."""
    found = [(start, 0, end) for start, end in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and is_luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 10 <= len(DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- Tokens and features

TOKEN = re.compile(r"\S+")
#: Tokens farther than REACH tokens from one of these are no personal data.
TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]", re.IGNORECASE)
REACH = 2
#: Label 0 is outside; kind k begins with 1 + 2 k and goes on with 2 + 2 k.
LABELS = 1 + 2 * len(KINDS)


def segments(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens (start, end) of a line around its triggers."""
    start = 0
    for line in text.split("\n"):
        if TRIGGER.search(line):
            tokens = [(m.start(), m.end()) for m in TOKEN.finditer(line)]
            near = [n for n, (a, b) in enumerate(tokens) if TRIGGER.search(line, a, b)]
            run: list[int] = []
            for place in near:
                if run and place - REACH > run[-1] + 1:
                    yield [(start + a, start + b) for a, b in (tokens[n] for n in run)]
                    run = []
                first = max(0, place - REACH, run[-1] + 1 if run else 0)
                run.extend(range(first, min(len(tokens), place + REACH + 1)))
            if run:
                yield [(start + a, start + b) for a, b in (tokens[n] for n in run)]
        start += len(line) + 1


def shape(token: str) -> str:
    """The token with letters as a or A and digits as 0; runs of letters are cut to one, of digits to four."""
    out: list[str] = []
    run = 0
    for c in token:
        s = "0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c
        run = run + 1 if out and out[-1] == s else 1
        if run == 1 or (s == "0" and run <= 4):
            out.append(s)
    return "".join(out)


def features(tokens: list[str]) -> list[list[str]]:
    """The names of the features of each token of a segment."""
    shapes = [shape(token) for token in tokens]
    words = [token.strip(".,;:!?\"'").lower() for token in tokens]
    out = []
    for n, token in enumerate(tokens):
        digits = sum(map(str.isdigit, token))
        before, after = (shapes[n - 1] if n else "<"), (shapes[n + 1] if n + 1 < len(tokens) else ">")
        out.append([
            "bias", f"s={shapes[n]}", f"n={min(digits, 20)}", f"l={min(len(token), 20)}", f"p={before}", f"q={after}",
            f"ps={before}|{shapes[n]}", f"sq={shapes[n]}|{after}", f"wp={words[n - 1] if n else '<'}", f"w={words[n]}",
        ])
    return out


# ---- The field

@dataclass
class Field:
    """Weights of feature and label, and of neighbouring labels; the first label has its own."""

    names: dict[str, int]
    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Per token and label; features that training has not seen count nothing."""
        known = [[self.names[x] for x in row if x in self.names] for row in features(tokens)]
        return np.array([self.emit[row].sum(axis=0) for row in known])

    def decode(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence of scores; sequences of equal length go together."""
        found: list = [None] * len(lines)
        lengths: dict[int, list[int]] = {}
        for n, line in enumerate(lines):
            lengths.setdefault(len(line), []).append(n)
        for length, members in lengths.items():
            scores = np.stack([lines[n] for n in members])
            best, back = scores[:, 0] + self.first, []
            for t in range(1, length):
                ways = best[:, :, None] + self.step
                back.append(ways.argmax(axis=1))
                best = ways.max(axis=1) + scores[:, t]
            path = [best.argmax(axis=1)]
            for choice in reversed(back):
                path.append(choice[np.arange(len(members)), path[-1]])
            for n, labels in zip(members, np.stack(path[::-1], axis=1), strict=True):
                found[n] = labels
        return found


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[str], list[int]]], rounds: int = 120, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam, from rows of (tokens, labels).

    Labels that cannot follow each other (going on with what has not begun) never do.
    """
    listed = [features(tokens) for tokens, _ in table]
    names = {name: n for n, name in enumerate(sorted({x for line in listed for row in line for x in row}))}
    longest = max(len(tokens) for tokens, _ in table)
    size, count = len(names), len(table)
    # The numbers of each token's features; one more feature, of weight 0, fills shorter lines.
    x = np.full((count, longest, max(len(row) for line in listed for row in line)), size)
    gold = np.zeros((count, longest, LABELS))
    mask = np.zeros((count, longest), bool)
    for n, (line, (_, labels)) in enumerate(zip(listed, table, strict=True)):
        for t, (row, label) in enumerate(zip(line, labels, strict=True)):
            x[n, t, : len(row)] = [names[name] for name in row]
            gold[n, t, label] = 1
            mask[n, t] = True
    own, used = x[mask].ravel(), x.shape[2]
    banned = np.array([[b > 0 and b % 2 == 0 and a not in (b, b - 1) for b in range(LABELS)] for a in range(LABELS)])
    never = -1e4 * banned
    start = np.array([-1e4 if b and b % 2 == 0 else 0.0 for b in range(LABELS)])
    emit, step = np.zeros((size + 1, LABELS)), np.zeros((LABELS, LABELS))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (emit, step)]
    follows = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    for turn in range(1, rounds + 1):
        scores = emit[x].sum(axis=2)
        move = step + never
        forward, backward = [scores[:, 0] + start], [np.zeros((count, LABELS))]
        for t in range(1, longest):
            new = _log_sum(forward[-1][:, :, None] + move, 1) + scores[:, t]
            forward.append(np.where(mask[:, t, None], new, forward[-1]))
        for t in range(longest - 1, 0, -1):
            new = _log_sum(move + (scores[:, t] + backward[-1])[:, None, :], 2)
            backward.append(np.where(mask[:, t, None], new, backward[-1]))
        backward.reverse()
        total = _log_sum(forward[-1], 1)
        expected = np.exp(np.stack(forward, 1) + np.stack(backward, 1) - total[:, None, None]) * mask[:, :, None]
        pairs = np.zeros((LABELS, LABELS))
        for t in range(1, longest):
            joint = forward[t - 1][:, :, None] + move + (scores[:, t] + backward[t])[:, None, :] - total[:, None, None]
            pairs += np.exp(joint)[mask[:, t]].sum(axis=0)
        missing = np.repeat((gold - expected)[mask], used, axis=0)
        seen = np.stack([np.bincount(own, missing[:, label], size + 1) for label in range(LABELS)], axis=1)
        slopes = (
            seen / count - decay * emit,
            (follows - pairs) / count - decay * step,
        )
        for weights, slope, (mean, square) in zip((emit, step), slopes, moments, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope**2 - square)
            weights += rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
        emit[size] = 0
    return Field(names, emit, step + never, start)


def labelled_table(rows: int = 600, seed: int = 1) -> list[tuple[list[str], list[int]]]:
    """A small labelled table: short lines made by rule, with personal data in several notations.

    A third of the rows have none, but numbers, dates, prices, versions and identifiers.
    """
    rng = np.random.default_rng(seed)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstuvé"), rng.integers(2, 9)))
    pick = lambda *options: options[rng.integers(len(options))]()
    made = {
        0: lambda: pick(
            lambda: f"{word()}.{word()}{number(2)}@{word()}.{word()[:3]}", lambda: f"{word()}@{word()}.org",
            lambda: f"{word()} [at] {word()}.com", lambda: f"{word()} (at) {word()} (dot) org", lambda: f"{word()} [at] {word()} [dot] net"),
        1: lambda: pick(
            lambda: ".".join(str(x) for x in rng.integers(0, 256, 4)), lambda: f"{rng.integers(1, 255)}.{rng.integers(1, 255)}.0.1"),
        2: lambda: pick(
            lambda: number(16), lambda: " ".join(number(4) for _ in range(4)), lambda: "-".join(number(4) for _ in range(4)),
            lambda: ".".join(number(4) for _ in range(4))),
        3: lambda: pick(
            lambda: f"+{rng.integers(1, 9)} ({number(3)}) {number(3)}-{number(4)}", lambda: f"({number(3)}) {number(3)}-{number(4)}",
            lambda: f"{number(3)}-{number(3)}-{number(4)}", lambda: f"+{number(2)} {number(3)} {number(7)}",
            lambda: f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}", lambda: f"{number(3)}.{number(3)}.{number(4)}"),
    }
    others = (
        lambda: f"{rng.integers(1, 400)}", lambda: f"20{number(2)}-0{rng.integers(1, 9)}-1{number(1)}", lambda: f"{rng.integers(1, 99)}.{number(2)}",
        lambda: f"1{number(1)}:3{number(1)}", lambda: f"version {rng.integers(1, 9)}.", lambda: f"{rng.integers(1, 9)}.{number(1)}.{number(1)}",
        lambda: f'token = "{number(6)}{word()}{number(5)}{word()}{number(9)}"', lambda: f"19{number(2)}", lambda: f"{number(9)}{word()}",
        lambda: f"{rng.integers(1, 99)},{number(3)}", lambda: f"{number(4)} {number(3)}", lambda: f"{word()}{number(2)}", lambda: f"{number(13)}",
        lambda: f"{number(6)}-{number(2)}", lambda: f"{number(3)} - {number(3)}", lambda: f"@{word()}", lambda: f"{rng.integers(1, 90)}%",
    )
    lead = {0: ("email", "mail:", "contact"), 1: ("ip", "host", "from"), 2: ("card", "visa:", "paid"), 3: ("tel", "phone:", "call")}
    ends = ("", "", "", ".", ",", "!!", "%%%", "###", "&&&")
    table = []
    for n in range(rows):
        tokens = [word() for _ in range(rng.integers(0, 3))]
        labels = [0] * len(tokens)
        if n % 3:
            kind = int(rng.integers(0, 4))
            if rng.random() < 0.4:
                tokens.append(str(rng.choice(lead[kind])))
                labels.append(0)
            parts = made[kind]().split(" ")
            labels += [1 + 2 * kind] + [2 + 2 * kind] * (len(parts) - 1)
        else:
            parts = others[rng.integers(len(others))]().split(" ")
            labels += [0] * len(parts)
        parts[-1] += str(rng.choice(ends))
        tokens += parts
        for _ in range(rng.integers(0, 3)):
            tokens.append(word())
            labels.append(0)
        table.append((tokens, labels))
    return table


EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")
#: What an added span must look like besides its label, and its least and largest number of digits.
BODY = (
    re.compile(r"[^\s@]+(?:@| ?[\[(]at[\])] ?)[^\s@]+(?: [\[(]dot[\])] [^\s@]+)*", re.IGNORECASE),
    re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ .-]?[0-9])+"),
    re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]"),
)
DIGITS = ((0, 99), (4, 12), (14, 19), (9, 15))


def fits(kind: int, body: str) -> bool:
    digits = "".join(DIGIT.findall(body))
    low, high = DIGITS[kind]
    return (
        low <= len(digits) <= high
        and BODY[kind].fullmatch(body) is not None
        and (kind != 1 or all(int(part) <= 255 for part in body.split(".")))
        and (kind != 2 or is_luhn(digits))
    )


def added_spans(text: str, tokens: list[tuple[int, int]], labels: np.ndarray, taken: list[Span]) -> list[Span]:
    """Spans of the labels, without punctuation around them, that overlap none taken."""
    found, n = [], 0
    while n < len(labels):
        if not labels[n]:
            n += 1
            continue
        kind, last = (int(labels[n]) - 1) // 2, n
        while last + 1 < len(labels) and labels[last + 1] == 2 + 2 * kind:
            last += 1
        start, end = tokens[n][0], tokens[last][1]
        n = last + 1
        raw = text[start:end]
        body = EDGE.sub("", raw)
        start += raw.find(body)
        end = start + len(body)
        if fits(kind, body) and all(end <= a or b <= start for a, _, b in taken):
            found.append((start, kind, end))
    return found


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def personal_data(docs: DataFrame, field: Field | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and the digest are those of the patterns' spans; ``spans`` has these and what the field adds, as
    kind:start:end in code points, the end exclusive, by start and kind.  A null or empty text has
    no spans.  Repeated rows give equal rows; other columns are not read; an empty table gives an
    empty result.
    """
    # The field was learned from a table of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(field or train(labelled_table()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [value or "" for value in batch.column("text").to_pylist()]
            base = [base_spans(value) for value in texts]
            runs = [(n, run) for n, value in enumerate(texts) for run in segments(value)]
            labels = model.decode([model.scores([texts[n][a:b] for a, b in run]) for n, run in runs])
            every = [list(spans) for spans in base]
            for (n, run), found in zip(runs, labels, strict=True):
                every[n] += added_spans(texts[n], run, found, base[n])
            counts = [pa.array([sum(k == kind for _, k, _ in spans) for spans in base], pa.int64()) for kind in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([sha256(named(spans).encode()).hexdigest() for spans in base], pa.string()),
                 pa.array([named(spans) for spans in every], pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(find, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
