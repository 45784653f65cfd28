"""64-bit hashes of words and of word windows, computed for a block of texts at once.

A word is a run of bytes other than the six ASCII white-space characters; UTF-8
keeps these apart from all other characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from passbook.llm.texts import BLOCK_BYTES, blocks, utf8

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LONGEST_PIECE = 4 * BLOCK_BYTES

_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base ** i mod 2 ** 64 for i < size."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        factors = np.full(max(size, _LONGEST_PIECE // 2), base, U64)
        factors[0] = 1
        have = np.cumprod(factors, dtype=U64)
        if size <= _LONGEST_PIECE:
            _powers[base] = have
    return have[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (splitmix64)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def is_white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return data + ((data >= 65) & (data <= 90)) * np.uint8(32)


def _spans(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; no word goes over an edge between texts."""
    inside = ~is_white(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] |= inside[inner]
    last[inner - 1] |= inside[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    terms = (data.astype(U64) + U64(1)) * _power(_BASE, len(data))
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum(terms, out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(data))[starts]
    return mixed(value + (ends - starts).astype(U64))


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at white space."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data):
            white = np.flatnonzero(is_white(data[end : end + BLOCK_BYTES]))
            if len(white):
                end += int(white[0])
                break
            end = min(end + BLOCK_BYTES, len(data))
        yield data[at:end]
        at = end


def word_hashes(
    texts: pa.Array, lower: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, flat word hashes, and the n + 1 places where texts begin."""
    data, offsets = utf8(texts)
    for first, last in blocks(offsets):
        block = data[offsets[first] : offsets[last]]
        block = lowered(block) if lower else block
        edges = offsets[first : last + 1] - offsets[first]
        if len(block) > _LONGEST_PIECE:  # one long text
            found = []
            for piece in _pieces(block):
                found.append(_hashed(piece, *_spans(piece, np.zeros(0, np.int64))))
            words = np.concatenate(found)
            yield first, last, words, np.array([0, len(words)])
        else:
            starts, ends = _spans(block, edges)
            yield first, last, _hashed(block, starts, ends), np.searchsorted(starts, edges)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each place on; shorter by size - 1."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, U64)
    for j, factor in enumerate(mixed(np.arange(1, size + 1, dtype=U64) * U64(_BASE))):
        total += words[j : j + count] * (factor | U64(1))
    return mixed(total + U64(size))
