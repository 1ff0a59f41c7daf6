"""Vectorised word splitting and 64-bit word hashes over Arrow string columns.

Words are maximal runs of bytes of a class; all bytes from 0x80 on belong to words, so UTF-8 characters stay whole.
Words of up to 64 bytes are hashed as polynomials of random values, longer ones (for which such polynomials modulo 2**64
have known collisions) by BLAKE2b. Two of n different words share a hash with a chance of about n**2 / 2**65."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: ``[^\x20\x09-\x0D]``
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False

_MULT = 0x9E3779B97F4A7C15
_POWERS = {"n": 0}
#: glibc's way to hand back the free parts of its heap; other C libraries have none
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
LONG = 64
VALUES = (np.random.RandomState(20240607).randint(1, 2**62, 256).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT ** i and its inverse modulo 2**64 for i < n."""
    if _POWERS["n"] < n:
        size = max(n, 1 << 16)
        if size > 1 << 24:  # for one very long text; not kept
            up, down = np.full(n, _MULT, np.uint64), np.full(n, pow(_MULT, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            return np.cumprod(up), np.cumprod(down)
        up, down = np.full(size, _MULT, np.uint64), np.full(size, pow(_MULT, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the UTF-8 of all rows and where each begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the machine: Python workers live on from task to task, beside each other."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most`` bytes of text (a longer row makes a piece of its own)."""
    for b in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
            yield b.slice(at, end - at)
            at = end
        give_back()


def words(column: pa.Array, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the hash of each word of all rows in order, and bounds[i]:bounds[i+1] the words of row i."""
    data, offsets = text_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = LOWER[data]
    inside = kind[low]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    before[first] = False
    begins = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after)
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        total = np.cumsum(VALUES[low] * up)
        h = (total[ends] - np.where(begins > 0, total[begins - 1], np.uint64(0))) * down[begins]
        h = mix(h + (ends - begins + 1).astype(np.uint64))
    for i in np.flatnonzero(ends - begins >= LONG):
        h[i] = int.from_bytes(blake2b(low[begins[i] : ends[i] + 1].tobytes(), digest_size=8).digest(), "little")
    return h, np.searchsorted(begins, offsets)


def shingles(h: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of each row's runs of ``size`` words; a shorter, non-empty row makes one of all its words."""
    count = np.diff(bounds)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(made)])
    full = np.repeat(count >= size, made)
    begin = np.arange(out[-1]) - np.repeat(out[:-1], made) + np.repeat(bounds[:-1], made)
    s = np.zeros(out[-1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            s = mix(s * np.uint64(_MULT) + h[np.minimum(begin + k, max(len(h) - 1, 0))]) if len(h) else s
        for i in np.flatnonzero(~full):  # rows of fewer words
            row = int(np.searchsorted(out, i, "right")) - 1
            x = np.uint64(0)
            for w in h[bounds[row] : bounds[row + 1]]:
                x = mix(np.array([x * np.uint64(_MULT) + w], np.uint64))[0]
            s[i] = mix(np.array([x + np.uint64(count[row])], np.uint64))[0]
    return s, out
