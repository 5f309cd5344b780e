"""Vectorised 64-bit word hashes of UTF-8 texts, in numpy.

A word's hash is a polynomial over its bytes, taken from running sums, and then mixed; the cost
is a few array operations per byte and none per word. Long texts go through in pieces that end
between words, so the work space stays at a few times ``PIECE`` bytes.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE = 1 << 18             # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def separators(keep_punctuation: bool) -> np.ndarray:
    """Which bytes part words: ASCII white space, or everything in ASCII but letters and digits."""
    out = np.zeros(256, bool)
    out[9:14] = out[32] = True
    if not keep_punctuation:
        out[:128] = [not chr(b).isalnum() for b in range(128)]
    return out


WHITE, NON_WORD = separators(True), separators(False)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _piece(raw: bytes, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``raw`` and where they start."""
    data = np.frombuffer(raw, np.uint8)
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~parts[data]
    turn = np.flatnonzero(word[1:] != word[:-1])
    start, end = turn[::2], turn[1::2]
    up, down = _powers(max(2 * PIECE, 1 << (len(data) + 1).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start]), start


def word_hashes(texts: list[bytes], parts: np.ndarray = WHITE) -> list[np.ndarray]:
    """The word hashes of each text, in order. ``parts``: ``WHITE`` or ``NON_WORD``."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE:
            raw, pieces, low = texts[at], [], 0
            while low < len(raw):
                high = min(len(raw), low + PIECE)
                while high < len(raw) and not parts[raw[high]]:
                    high += 1
                pieces.append(_piece(raw[low:high], parts)[0])
                low = high
            out.append(np.concatenate(pieces))
            at += 1
            continue
        first, size = at, 0
        while at < len(texts) and size + len(texts[at]) <= PIECE:
            size += len(texts[at]) + 1
            at += 1
        hashes, start = _piece(b" ".join(texts[first:at]), parts)
        ends = np.cumsum([len(t) + 1 for t in texts[first:at]])
        out += np.split(hashes, np.searchsorted(start, ends[:-1]))
    return out


TEXT_AT_ONCE = 4 << 20       # bytes of text that a task takes out of a batch at a time


def sliced(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``TEXT_AT_ONCE`` bytes of text (at least one row).

    Batches come by number of rows, so long texts would make the work space of a batch as large as they are together.
    """
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, before + TEXT_AT_ONCE, "right")))
        yield batch.slice(low, high - low)
        low = high


def release() -> None:
    """Give what a worker no longer uses back to the system; a worker lives on after its task."""
    _powers.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # another C library
        pass


KEPT: dict[str, Callable[[], None]] = {}   # what an operator keeps in a worker between its tasks, and how it is dropped


def drop_kept(keeps: str | None = None) -> None:
    """Drop what operators keep in this worker, but for what ``keeps`` names.

    A function of this module, so that a worker gets it by name: a task's own code comes with copies of what it refers to.
    """
    for name, drop in KEPT.items():
        if name != keeps:
            drop()


def released(run: Callable, keeps: str | None = None) -> Callable:
    """``run`` over batches, with its work space given back when the task ends.

    What other operators keep in this worker is dropped first; ``keeps`` names what is this one's own.
    """

    @functools.wraps(run)
    def wrapper(batches):
        drop_kept(keeps)
        try:
            yield from run(batches)
        finally:
            release()

    return wrapper
