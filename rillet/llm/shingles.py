"""Sets of word shingles as 64-bit hashes, computed in numpy."""

import numpy as np

_SEED = np.random.default_rng(20240501)
#: A random number for each byte value; upper-case A-Z have those of a-z.
_BYTES = _SEED.integers(0, 1 << 64, 256, np.uint64)
_LOWERED = _BYTES.copy()
_LOWERED[65:91] = _BYTES[97:123]
_POWER, _STEP, _SHORT = (int(x) | 1 for x in _SEED.integers(0, 1 << 63, 3, np.uint64))
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Also all ASCII characters other than letters and digits.
_MARKS = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all others (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    steps = np.full(count, _POWER, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


_POWERS = _powers(256)


def word_hashes(text: str, marks: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash per word, and the bytes at which words begin and end.

    Words are separated by the six ASCII white-space characters, with ``marks`` also by all other
    ASCII characters that are neither letters nor digits.  A-Z count as a-z.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~(_MARKS if marks else _SPACES)[data]
    edges = np.diff(inside)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(begins):
        return np.empty(0, np.uint64), begins, ends
    lengths = ends - begins
    firsts = np.cumsum(lengths) - lengths
    places = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    values = _LOWERED[data[inside[1:-1].astype(bool)]] * powers[places]
    return mixed(np.add.reduceat(values, firsts)), begins, ends


#: Words of a full shingle; runs of fewer words never equal one.
FULL = 5


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    if len(words) < width or not width:
        return np.empty(0, np.uint64)
    step, ends = np.uint64(_STEP), len(words) - width + 1
    total = words[:ends].copy()
    for place in range(1, width):
        total = total * step + words[place : ends + place]
    return mixed(total + np.uint64(0 if width == FULL else _SHORT * width % 2**64))


def shingle_hashes(words: np.ndarray, size: int = FULL) -> np.ndarray:
    """A hash per run of ``size`` words; of fewer words the whole sequence is one shingle."""
    return run_hashes(words, min(len(words), size))


def shingle_set(text: str | None, size: int = FULL) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingle_hashes(word_hashes(text or "")[0], size))
