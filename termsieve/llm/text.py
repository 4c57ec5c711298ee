"""Vectorised word and shingle hashing over whole texts.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D; only A-Z are lower-cased.
Each word gets a 64-bit polynomial hash of its UTF-8 bytes, computed for a whole block of texts at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240607)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)
BASE_INV = U64(pow(int(BASE), -1, 2**64))
STEP = _RNG.integers(1, 2**63, 16, dtype=np.int64).astype(U64) * U64(2) + U64(1)
#: Bytes of text hashed at once; a longer text is a block of its own.
BLOCK = 1 << 18
_BLANK = re.compile(rb"[ \t\n\x0b\f\r]")
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; those of a block are kept."""
    if not _powers or len(_powers[0]) < n:
        up, down = np.full(max(n, BLOCK + 2), BASE, U64), np.full(max(n, BLOCK + 2), BASE_INV, U64)
        up[0] = down[0] = 1
        both = [np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)]
        if n > BLOCK + 2:
            return both[0], both[1]
        _powers[:] = both
    return _powers[0], _powers[1]


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow column as UTF-8, without decoding them; few are copied at a time."""
    column = column.cast(pa.binary())
    for i in range(0, len(column), 64):
        yield from column.slice(i, 64).to_pylist()


def batches(texts: Iterable[bytes | None], limit: int = BLOCK) -> Iterator[list[bytes]]:
    """Runs of consecutive texts of about `limit` bytes; a longer text is a run of its own."""
    held, size = [], 0
    for t in texts:
        raw = t or b""
        if held and size + len(raw) > limit:
            yield held
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield held


def blocks(texts: Iterable[bytes | None], limit: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """The same in lower case, each with the index of its first text."""
    first = 0
    for raw in batches(texts, limit):
        yield first, [r.lower() for r in raw]  # bytes.lower() changes A-Z alone
        first += len(raw)


def segments(raw: bytes, limit: int = BLOCK) -> Iterator[bytes]:
    """A text in stretches of about `limit` bytes that end behind white space."""
    at = 0
    while at < len(raw):
        found = _BLANK.search(raw, at + limit)
        end = found.end() if found else len(raw)
        yield raw[at:end]
        at = end


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of bytes that end in white space."""
    inside = ~SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash for each span of bytes."""
    up, down = powers(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the texts, and for each text the index of its first word (with an end).

    A long text is hashed a segment at a time.
    """
    if len(raw) == 1 and len(raw[0]) > 2 * BLOCK:
        found = np.concatenate([_block_hashes([part])[0] for part in segments(raw[0], BLOCK)])
        return found, np.array([0, len(found)])
    return _block_hashes(raw)


def _block_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    starts, ends = runs(data)
    at = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    return span_hashes(data, starts, ends, BYTE), np.searchsorted(starts, at)


def shingles(words: np.ndarray, first: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text of fewer words has its whole sequence as one."""
    out: list[np.ndarray] = []
    total = len(words) - size + 1
    run = np.zeros(max(total, 0), U64)
    for j in range(size):
        if total > 0:
            run += words[j : j + total] * STEP[j]
    run = mix(run)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        if n >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif n:
            out.append(mix((words[a:b] * STEP[:n]).sum(dtype=U64, keepdims=True) + STEP[size + n]))
        else:
            out.append(np.empty(0, U64))
    return out
