"""Images as arrays for the encoders: resize, crop, scale; latents back to pixels."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def _line(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``size`` points the two neighbours among n, and the share of the second."""
    at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, n - 1), at - low


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize of (height, width, channels)."""
    y0, y1, fy = _line(image.shape[0], height)
    x0, x1, fx = _line(image.shape[1], width)
    image = image.astype(np.float64)
    rows = image[y0] * (1 - fy)[:, None, None] + image[y1] * fy[:, None, None]
    return rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]


def centre_crop(image: np.ndarray, side: int = 256) -> np.ndarray:
    """Shorter side to ``side``, then the square in the middle."""
    h, w = image.shape[:2]
    scale = side / min(h, w)
    big = resized(image, max(side, round(h * scale)), max(side, round(w * scale)))
    top, left = (big.shape[0] - side) // 2, (big.shape[1] - side) // 2
    return big[top : top + side, left : left + side]


def encoder_input(image: np.ndarray, side: int = 256) -> np.ndarray:
    """A centre crop, channels first, values from -1 to 1."""
    crop = centre_crop(image, side) / 255.0
    return ((crop - 0.5) / 0.5).transpose(2, 0, 1).astype(np.float32)


def png_bytes(image: np.ndarray) -> bytes:
    """An RGB image (height, width, 3) as a PNG file; values are rounded to 8 bits."""
    pixels = np.clip(np.floor(image + 0.5), 0, 255).astype(np.uint8)
    height, width = pixels.shape[:2]

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)  # each line without a filter
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def storage_mb(files: int, elements: int, width: int = 2) -> float:
    return files * elements * width / 2**20


def checked_shape(values: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The array without a leading axis of one; another shape is an error."""
    if values.ndim == len(shape) + 1 and values.shape[0] == 1:
        values = values[0]
    if values.shape != shape:
        raise ValueError(f"shape {values.shape}, {shape} expected")
    return values
