"""Integer arrays as compressed bytes, for rows that carry many numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as zstd-compressed byte planes."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(planes.T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    """The packed integers, as uint64."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(blob[1:])), dtype=np.uint8)
    planes = raw.reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :blob[0]] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers, packed by their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)
