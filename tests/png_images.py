"""PNG writing for test fixtures (zlib only, no imaging library).

Used by the tests to build image trees; not part of any registered query.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def png_bytes(pixels: np.ndarray) -> bytes:
    """8-bit PNG from an (h, w) greyscale or (h, w, 3) RGB uint8 array (filter type 0)."""
    arr = np.asarray(pixels, dtype=np.uint8)
    if arr.ndim == 2:
        color, h, w = 0, arr.shape[0], arr.shape[1]
        rows = arr
    else:
        color, h, w = 2, arr.shape[0], arr.shape[1]
        rows = arr.reshape(h, w * 3)
    raw = b"".join(b"\x00" + rows[y].tobytes() for y in range(h))
    header = struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")
