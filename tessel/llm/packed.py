"""Integers packed into bytes, for tables between two jobs."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Integers from 0 to 2^32 - 1 as zstd over their byte planes; planes that hold only zeros are left out."""
    flat = np.ascontiguousarray(values, dtype="<u4")
    planes = flat.view(np.uint8).reshape(-1, 4).T
    used = max(1, int(flat.max(initial=0)).bit_length() + 7 >> 3)
    return bytes([used]) + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack(content: bytes) -> np.ndarray:
    """The integers of ``pack``, as int64."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(content[1:]), np.uint8).reshape(content[0], -1)
    return sum(plane.astype(np.int64) << 8 * k for k, plane in enumerate(planes))
