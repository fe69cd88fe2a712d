"""Words, hashes and ragged arrays over a block of texts, as numpy code.

Spark deals out the rows; inside a task a batch is cut into blocks of about
``BLOCK_BYTES`` so that temporary arrays stay small however long the batch is.
A text is never cut: one that is longer forms a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2^64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers(exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to 2^exponent entries."""
    n = 1 << exponent
    out = []
    for base in (_BASE, _BASE_INVERSE):
        powers = np.full(n, base, _U)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def spans_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``codes[start:end]``; equal slices have equal hashes.

    ``codes`` are random 64-bit values of the symbols. A prefix sum of
    code * base^position makes the cost independent of the slices' lengths.
    """
    # one table serves all ordinary blocks; a longer text gets a longer one
    power, inverse = _powers(max(BLOCK_BYTES.bit_length(), len(codes).bit_length()))
    total = np.empty(len(codes) + 1, _U)
    total[0] = 0
    np.cumsum(codes * power[: len(codes)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + mix((end - start).astype(_U)))


@lru_cache(maxsize=4)
def byte_codes(lower: bool) -> np.ndarray:
    """A 64-bit value for each byte; A-Z share those of a-z if ``lower``."""
    codes = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def _class(allowed) -> np.ndarray:
    return np.array([allowed(b) for b in range(256)])


#: words are runs of anything but ASCII white space
NOT_SPACE = _class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: words are runs of digits, letters a-z (any case) and non-ASCII characters
ALPHANUMERIC = _class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


class Block:
    """Texts joined by one space: ``data`` bytes, text i at ``begin[i]:finish[i]``."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.finish = np.cumsum(sizes + 1) - 1
        self.begin = self.finish - sizes

    def __len__(self) -> int:
        return len(self.texts)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each byte position (or separator after it) belongs to."""
        return np.searchsorted(self.finish, at, "left")

    def per_text(self, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        counts = np.bincount(owner, weights, minlength=len(self))
        return np.rint(counts).astype(np.int64) if weights is not None else counts.astype(np.int64)


class Words:
    """The words of a block: byte spans, owning text, hash and place within the text."""

    def __init__(self, block: Block, letters: np.ndarray = NOT_SPACE, lower: bool = False):
        inside = letters[block.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]  # the last byte is a space, so runs close
        self.inside = inside
        self.hash = spans_hash(byte_codes(lower)[block.data], self.start, self.end)
        self.owner = block.owner(self.start)
        self.count = block.per_text(self.owner)
        self.first = np.cumsum(self.count) - self.count

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of ``width`` words of one text."""
        if len(self) < width:
            return np.empty(0, np.int64), np.empty(0, _U)
        n = len(self) - width + 1
        at = np.flatnonzero(self.owner[:n] == self.owner[width - 1 :])
        return at, window_hash(self.hash, at, width)


def window_hash(word_hash: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    total = np.zeros(len(at), _U)
    for j in range(width):
        total = total * _U(_BASE) + word_hash[at + j]
    return mix(total + _U(width))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated ranges start..start+size."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def covered(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the ``n`` items that lie in any range first..first+width."""
    change = np.bincount(first, minlength=n + 1) - np.bincount(first + width, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(batch: pa.RecordBatch, text: str, limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Consecutive parts of a batch of at most about ``limit`` (``BLOCK_BYTES``) of text each."""
    limit = limit or BLOCK_BYTES
    values = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = size = 0
    for i, value in enumerate(values):
        if size and size + len(value) > limit:
            yield batch.slice(start, i - start), Block(values[start:i])
            start, size = i, 0
        size += len(value) + 1
    if size:
        yield batch.slice(start), Block(values[start:])


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
