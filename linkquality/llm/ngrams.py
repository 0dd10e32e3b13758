"""Hashed n-grams of whole texts, computed on byte arrays with numpy."""

from __future__ import annotations

BLOCK = 1 << 20


def pieces(data: bytes, size: int = BLOCK):
    """Views of ``data`` of at most about ``size`` bytes, cut at blanks where
    there are any, so that a long text is counted in bounded memory."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            cut = data.rfind(b" ", at + 1, end)
            end = cut if cut > at else end
        yield data[at:end]
        at = end


def ngram_buckets(data: bytes, n: int, bits: int):
    """Bucket (0 to 2**bits - 1) of every n-byte run of ``data``."""
    import numpy as np
    b = np.frombuffer(data, np.uint8)
    if len(b) < n:
        return np.zeros(0, np.uint32)
    h = np.full(len(b) - n + 1, n, np.uint32)
    for k in range(n):
        h *= np.uint32(0x01000193)
        h ^= b[k:len(b) - n + 1 + k]
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - bits)


def word_hashes(data: bytes):
    """64-bit hash of every word of ``data``, words parted by single blanks."""
    import numpy as np
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(b == 32)
    starts = np.concatenate([[0], gaps + 1])
    starts = starts[starts < len(b)]
    at = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(at.max()) + 1, 0x100000001B3, np.uint64))
        h = np.add.reduceat(np.where(b == 32, 0, (b + np.uint64(1)) * power[at]), starts)
        h ^= h >> np.uint64(31)
        return h * np.uint64(0x9E3779B97F4A7C15)
