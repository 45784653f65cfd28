"""Token ids of whole texts, one encoding per distinct chunk.

The tokenizer drops white space and never joins symbols across it, so a text's ids
are those of its chunks between ASCII white space, in order.  Chunks are coded once
per batch and kept in a store of bounded size per Python worker; that makes the
ids many times cheaper than coding every text afresh.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from passbook.llm.texts import blocks, utf8
from passbook.llm.words import lowered

TOKENIZER = "word_bpe_49k.json"
STORED_CHUNKS = 300_000
BLOCK = 4 << 20
STORED_CHUNK_BYTES = 64
IDS = np.dtype("<u4")


class ChunkCoder:
    """Ids, as little-endian unsigned 32-bit bytes, of chunks without white space."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.stored: dict[bytes, bytes] = {}

    def code(self, chunks: list[bytes]) -> list[bytes]:
        stored = self.stored
        found = [stored.get(chunk) for chunk in chunks]
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            texts = [chunks[i].decode() for i in missing]
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            if len(stored) + len(missing) > STORED_CHUNKS:
                stored.clear()
            for i, encoding in zip(missing, coded, strict=True):
                found[i] = np.array(encoding.ids, IDS).tobytes()
                if len(chunks[i]) <= STORED_CHUNK_BYTES:
                    stored[chunks[i]] = found[i]
        return found


_coders: dict[str, ChunkCoder] = {}


def coder(path: str) -> ChunkCoder:
    """The worker's coder for this tokenizer file."""
    if path not in _coders:
        _coders[path] = ChunkCoder(path)
    return _coders[path]


def chunked(texts: pa.Array) -> pa.Array:
    """The texts rewritten so that more chunks are alike; their ids stay the same.

    The tokenizer lowers letters itself, and always parts a letter or digit from a
    stop or comma, so white space may stand between them.  Texts with marks like those
    of special tokens, which are told by case, are left alone.
    """
    data, offsets = utf8(texts)
    start, offsets = offsets[0], offsets - offsets[0]
    data = data[start : start + offsets[-1]]
    if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
        data = lowered(data)
    alphanumeric = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    stop = (data[1:] == ord(".")) | (data[1:] == ord(","))
    at = np.flatnonzero(stop & alphanumeric[:-1]) + 1
    moved = offsets + np.searchsorted(at, offsets)
    out = np.full(len(data) + len(at), 32, np.uint8)
    kept = np.ones(len(out), bool)
    kept[at + np.arange(len(at))] = False
    out[kept] = data
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved), pa.py_buffer(out))


def chunk_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a block of texts: flat ids, ids per chunk, chunks per text."""
    split = pc.ascii_split_whitespace(chunked(texts))
    coded = split.flatten().dictionary_encode()
    distinct = coder(path).code(coded.dictionary.cast(pa.large_binary()).to_pylist())
    chunks = np.diff(split.offsets.to_numpy())
    if len(coded) == 0:
        return np.zeros(0, IDS), np.zeros(0, np.int64), chunks
    taken = pa.array(distinct, pa.large_binary()).take(coded.indices)
    data, offsets = utf8(taken)
    return data.view(IDS), np.diff(offsets) // IDS.itemsize, chunks


def token_blocks(
    texts: pa.Array, path: str
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First and last row, flat ids, ids per chunk and chunks per text of each block."""
    texts = pc.fill_null(texts, "")
    _, offsets = utf8(texts)
    for first, last in blocks(offsets, BLOCK):
        yield first, last, *chunk_ids(texts.slice(first, last - first), path)


def text_ids(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text."""
    for first, last, ids, sizes, chunks in token_blocks(texts, path):
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(chunks))]
        for i in range(last - first):
            yield ids[ends[i] : ends[i + 1]]
