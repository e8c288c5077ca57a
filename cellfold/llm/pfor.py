"""A binary file format for token ids: patched frame-of-reference blocks.

    magic "PFR1" | block u32 | width of a doc id's null flag list u32 (0: none)
    n_docs u64 | n_ids u64 | n_blocks u64
    doc ids i64[n_docs] | null flags u8[...] | lengths u64[n_docs]
    block starts u64[n_blocks]                      byte offsets from the file's start
    blocks: minimum u32 | width u8 | n_exceptions u16
            packed (id - minimum), ``width`` bits each, little-endian bit order
            exception positions u16[...] | exception values u32[...]

A block's width is the number of bits that holds the given percentile of its
differences; larger ones are exceptions, stored whole. Any block can be read
alone through its start.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sIIQQQ")
_BLOCK = struct.Struct("<IBH")


def encode_block(ids: np.ndarray, percentile: float) -> bytes:
    low = int(ids.min())
    diff = (ids - np.uint32(low)).astype(np.uint32)
    k = min(len(diff) - 1, int(len(diff) * percentile))
    width = int(np.partition(diff, k)[k]).bit_length()
    over = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(np.ascontiguousarray(diff.astype("<u4")).view(np.uint8).reshape(-1, 4),
                         axis=1, count=width, bitorder="little") if width else np.zeros(0, np.uint8)
    return b"".join([_BLOCK.pack(low, width, len(over)),
                     np.packbits(bits.ravel(), bitorder="little").tobytes(),
                     over.astype("<u2").tobytes(), diff[over].astype("<u4").tobytes()])


def decode_block(data: memoryview, at: int, n: int) -> np.ndarray:
    low, width, n_over = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    size = -(-n * width // 8)
    out = np.zeros((n, 4), dtype=np.uint8)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width,
                             bitorder="little").reshape(n, width)
        whole = np.packbits(bits, axis=1, bitorder="little")
        out[:, :whole.shape[1]] = whole
    diff = out.view("<u4").ravel().copy()
    at += size
    pos = np.frombuffer(data, "<u2", n_over, at)
    diff[pos] = np.frombuffer(data, "<u4", n_over, at + 2 * n_over)
    return diff + np.uint32(low)


def encode_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray,
                block: int = 4096, percentile: float = 0.95) -> bytes:
    """The file of some documents' ids (each at most 32 bits), one after the other."""
    if not 1 <= block <= 1 << 16:
        raise ValueError("a block holds 1 to 65536 ids")
    ids = ids.astype(np.uint32)
    blocks = [encode_block(ids[i:i + block], percentile) for i in range(0, len(ids), block)]
    nulls = bytes(d is None for d in doc_ids) if any(d is None for d in doc_ids) else b""
    head = _HEAD.size + 8 * len(doc_ids) + len(nulls) + 8 * len(doc_ids) + 8 * len(blocks)
    starts = head + np.cumsum([0] + [len(b) for b in blocks[:-1]]) if blocks else np.zeros(0)
    return b"".join([
        _HEAD.pack(MAGIC, block, len(nulls), len(doc_ids), len(ids), len(blocks)),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(), nulls,
        np.asarray(lengths).astype("<u8").tobytes(), np.asarray(starts).astype("<u8").tobytes(), *blocks])


class File:
    """Reads a file; ``ids(start, stop)`` decodes only the blocks it needs."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.block, n_null, n_docs, self.n_ids, n_blocks = _HEAD.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        docs = np.frombuffer(self.data, "<i8", n_docs, at).tolist()
        at += 8 * n_docs
        null = bytes(self.data[at:at + n_null]) or bytes(n_docs)
        self.doc_ids = [None if x else d for d, x in zip(docs, null)]
        at += n_null
        self.lengths = np.frombuffer(self.data, "<u8", n_docs, at).astype(np.int64)
        self.starts = np.frombuffer(self.data, "<u8", n_blocks, at + 8 * n_docs)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else stop
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = [decode_block(self.data, int(self.starts[b]),
                              min(self.block, self.n_ids - b * self.block))
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block:stop - first * self.block]
