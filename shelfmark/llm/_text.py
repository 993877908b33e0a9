"""Words and their 64-bit hashes for many texts at once, in numpy, inside tasks.

Short texts are joined with a separator byte into pieces of at most ``PIECE`` bytes; a longer text is a piece of its own, of
which a task holds the bytes and its words' places and hashes (hashing itself goes by windows that end between words).
Hashing takes some ten arrays of eight bytes for each byte of a piece, which a worker that is kept for other tasks holds on to.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
#: Rows of a batch whose texts are strings of Python at once.
ROWS = 1000
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}

#: Lower-cases A-Z and nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WHITE = np.ones(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x20\x09-\x0D]+``
NOT_WHITE = _WHITE
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a lower-cased text; UTF-8 puts every other character above 0x7F.
ALNUM = _ALNUM


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finish, after which every bit depends on all."""
    h = h ^ (h >> np.uint64(32))
    h = h * _FOLD
    h = h ^ (h >> np.uint64(32))
    h = h * _FOLD
    return h ^ (h >> np.uint64(32))


def spans(buf: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = is_word[np.frombuffer(buf, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(buf: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out, raw, at = np.empty(len(starts), np.uint64), np.frombuffer(buf, np.uint8), 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = int(ends[to - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[raw[low:high]] * _power(_STEP, high - low), out=sums[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[b] - sums[a]) * _power(_BACK, high - low)[a])
        at = to
    return out


def few_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ROWS, which share the memory of those they are of."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def pieces(texts: Iterable[str | None]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(index of the first text, lower-cased bytes of some texts, where each begins); a null text is empty."""
    held: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
        if held and size + len(raw) > PIECE:
            yield first, b"\n".join(held), np.cumsum([0, *(len(x) + 1 for x in held[:-1])])
            held, first, size = [], i, 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, b"\n".join(held), np.cumsum([0, *(len(x) + 1 for x in held[:-1])])


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive words' hashes (len(words) - k + 1 of them, or none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_STEP) + words[j : j + n]
    return mix(total)


def shingle_sets(texts: Iterable[str | None], k: int, is_word: np.ndarray) -> Iterator[np.ndarray]:
    """Each text's distinct k-word shingles, sorted; with fewer words the whole sequence is one; none without words."""
    for _, buf, begins in pieces(texts):
        starts, ends = spans(buf, is_word)
        hashes = word_hashes(buf, starts, ends)
        cut = np.searchsorted(starts, [*begins, len(buf) + 1])
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            yield np.unique(shingle_hashes(hashes[a:b], min(k, int(b - a)))) if b > a else hashes[:0]
