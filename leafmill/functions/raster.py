"""Pixels of pages: contrast, and PNG files of crops."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Luma weights of red, green and blue; PNG colour types by number of channels.
LUMA = (0.299, 0.587, 0.114)
COLOUR_TYPES = {1: 0, 3: 2, 4: 6}


def contrast(pixels: np.ndarray) -> float:
    """Largest minus smallest grey value of (height, width) or (height, width, channels) bytes; 0 without pixels."""
    if not pixels.size:
        return 0.0
    grey = pixels if pixels.ndim == 2 else pixels[..., 0] if pixels.shape[2] == 1 else np.rint(pixels[..., :3] @ np.array(LUMA))
    return float(grey.max()) - float(grey.min())


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of grey, RGB or RGBA bytes."""
    shaped = np.ascontiguousarray(pixels if pixels.ndim == 3 else pixels[..., None], dtype=np.uint8)
    height, width, channels = shaped.shape
    lines = np.zeros((height, 1 + width * channels), np.uint8)  # every line begins with its filter: 0, none
    lines[:, 1:] = shaped.reshape(height, -1)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPES[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")
