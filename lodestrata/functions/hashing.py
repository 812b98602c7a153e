"""Perceptual and similarity hashes, their buckets and distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hamming(x: tuple[Column, ...], y: tuple[Column, ...]) -> Column:
    """Bits in which two hashes of equally many words differ."""
    total = None
    for a, b in zip(x, y, strict=True):
        n = F.bit_count(a.bitwiseXOR(b)).cast("int")
        total = n if total is None else total + n
    return total


def bucket_of(first_word: Column, bits: int, word_bits: int = 64) -> Column:
    """The leading ``bits`` of a hash as its bucket; more than a word has take the whole word, none gives bucket 0."""
    bits = min(bits, word_bits)
    if bits <= 0:
        return F.lit(0).cast("long")
    if word_bits == 64:
        return F.shiftrightunsigned(first_word.cast("long"), 64 - bits)
    return F.shiftright(first_word.cast("long"), word_bits - bits)


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A 64-bit similarity hash of lower-cased words, as two 32-bit words ``hi`` and ``lo``; no row for a text without words.

    Bit b is set if more than half of the words' digests have it.  Each text is hashed where it
    is read: exploding words would shuffle the whole corpus.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                lists = [t.split() if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]
                counts = np.array([len(x) for x in lists])
                some = np.flatnonzero(counts)
                place: dict[bytes, int] = {}
                ids = np.array([place.setdefault(w, len(place)) for x in lists for w in x], np.int64)
                digests = np.frombuffer(b"".join(hashlib.md5(w).digest()[:8] for w in place), ">u8")
                words = []
                for high in (32, 0):
                    out = np.zeros(len(some), np.int64)
                    for b in range(32):
                        bit = ((digests >> np.uint64(high + b)) & np.uint64(1)).astype(np.int64)
                        if len(some):
                            sums = np.add.reduceat(bit[ids], np.concatenate([[0], np.cumsum(counts[some])[:-1]]))
                            out |= (2 * sums > counts[some]).astype(np.int64) << b
                    words.append(pa.array(out))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), *words], names=[key, "hi", "lo"])

    return docs.select(key, F.lower(F.col(text)).alias(text)).mapInArrow(run, f"{key} {kind}, hi long, lo long")


def dct_hash(gray: np.ndarray, size: int = 16) -> list[int]:
    """Perceptual hash of a square gray image of side 4 * size: bits of the low DCT block above its median."""
    n = gray.shape[0]
    k = np.arange(n)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    low = (basis @ gray.astype(np.float64) @ basis.T)[:size, :size]
    bits = (low > np.median(low)).ravel()
    bits = np.concatenate([bits, np.zeros(-len(bits) % 64, bool)])
    return np.packbits(bits).view(">i8").astype(np.int64).tolist()


def resized(pixels: np.ndarray, side: int) -> np.ndarray:
    """A gray image as a square of 8-bit values, by a Lanczos filter of three lobes, first along rows."""

    def weights(n: int) -> np.ndarray:
        scale = n / side
        wide = max(scale, 1.0)
        centres = (np.arange(side) + 0.5) * scale
        low = np.maximum((centres - 3 * wide + 0.5).astype(int), 0)
        high = np.minimum((centres + 3 * wide + 0.5).astype(int), n)
        at = np.arange(n)
        x = (at + 0.5 - centres[:, None]) / wide
        w = np.where((np.abs(x) < 3) & (at >= low[:, None]) & (at < high[:, None]), np.sinc(x) * np.sinc(x / 3), 0.0)
        return w / w.sum(axis=1, keepdims=True)

    def rounded(values: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(values + 0.5), 0, 255)

    height, width = pixels.shape
    across = rounded(pixels.astype(np.float64) @ weights(width).T)
    return rounded(weights(height) @ across).astype(np.uint8)


def gray(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Luma of the pixels of Spark's image source (gray, BGR or BGRA)."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0]
    b, g, r = (pixels[:, :, k].astype(np.uint32) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def perceptual_hash(image: Column, size: int = 16) -> Column:
    """Hash of an image of Spark's image source (array of 64-bit words); null where it could not be decoded."""

    @F.pandas_udf("array<bigint>")
    def run(data: pd.Series, heights: pd.Series, widths: pd.Series, channels: pd.Series) -> pd.Series:
        return pd.Series([dct_hash(resized(gray(d, h, w, n), 4 * size), size) if h > 0 and w > 0 else None for d, h, w, n in zip(data, heights, widths, channels, strict=True)], dtype=object)

    return run(image["data"], image["height"], image["width"], image["nChannels"])
