"""Count tokens per section: encode whole documents once and join token spans to section spans.

Tokens of a byte-level vocabulary cover the UTF-8 bytes of a text without gaps, so their lengths give
their spans.  Encoding each section by itself would give other tokens at its borders.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = "n_tokens long, n_crossing long, sections array<struct<start:long, end:long, tokens:long>>"


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a vocabulary file and the number of bytes of each token."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def section_starts(data: bytes, separator: bytes) -> np.ndarray:
    """The bytes at which sections begin; a separator ends its section."""
    starts, place = [0], data.find(separator)
    while place >= 0:
        starts.append(place + len(separator))
        place = data.find(separator, starts[-1])
    return np.array(starts[:-1] if starts[-1] == len(data) else starts, np.int64)


def allocate(starts: np.ndarray, lengths: np.ndarray, sections: np.ndarray, end: int, rule: str):
    """For each token its section and whether it crosses a border.

    The rule names the section that gets a crossing token: that of its ``first`` or ``last`` byte, or
    the one with ``most`` of its bytes (the earliest of those with equally many).
    """
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, starts + lengths - 1, "right") - 1
    crossing = first != last
    owner = {"first": first, "last": last, "most": first.copy()}[rule]
    if rule == "most":
        borders = np.append(sections, end)
        for token in np.flatnonzero(crossing):
            own = np.arange(first[token], last[token] + 1)
            overlap = np.minimum(borders[own + 1], starts[token] + lengths[token]) - np.maximum(borders[own], starts[token])
            owner[token] = own[np.argmax(overlap)]
    return owner, crossing


def token_counts(
    docs: DataFrame, vocabulary: str = VOCABULARY, separator: str = "\n", rule: str = "first", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_crossing and its sections.

    A section is (start, end, tokens) in characters, the end exclusive and its separator included;
    sections cover the text, and their tokens add up to n_tokens.  ``rule`` says who gets a token
    that crosses a border (``allocate``); n_crossing counts these.  A null or empty text has no
    tokens and no sections.  Strings that look like special tokens are ordinary text.  Repeated
    rows give equal rows; other columns are not read; an empty table gives an empty result.

    ``vocabulary`` is a path on the driver; its content of a fixed size goes to the executors.
    """
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    mark = separator.encode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token_bytes = encoding(shared.value)
        for batch in batches:
            totals, crossed, sizes, columns = [], [], [0], ([], [], [])
            for value in batch.column("text").to_pylist():
                data = (value or "").encode()
                lengths = token_bytes[np.asarray(encoder.encode_ordinary(value), np.int64)] if data else np.empty(0, np.int64)
                sections = section_starts(data, mark) if data else np.empty(0, np.int64)
                owner, crossing = allocate(np.cumsum(lengths) - lengths, lengths, sections, len(data), rule)
                begins = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
                characters = np.concatenate([[0], np.cumsum(begins)])
                borders = characters[np.append(sections, len(data))]
                columns[0].append(borders[:-1])
                columns[1].append(borders[1:])
                columns[2].append(np.bincount(owner, minlength=len(sections)))
                totals.append(len(lengths))
                crossed.append(int(crossing.sum()))
                sizes.append(sizes[-1] + len(sections))
            fields = [pa.array(np.concatenate([np.empty(0, np.int64), *column])) for column in columns]
            spans = pa.StructArray.from_arrays(fields, ["start", "end", "tokens"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(crossed, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans)],
                ["doc_id", "n_tokens", "n_crossing", "sections"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, {SCHEMA}")
