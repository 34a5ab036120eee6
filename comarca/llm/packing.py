"""Many small numbers in one compressed cell."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(numbers: np.ndarray, rest: bytes = b"") -> bytes:
    """Four-byte numbers, their first bytes in front (the high ones are mostly zero), and what follows them."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(planes + rest)


def unpacked(data: bytes, n: int | None = None) -> tuple[np.ndarray, bytes]:
    """``n`` numbers, or all there are, and the rest."""
    plain = zstandard.ZstdDecompressor().decompress(data)
    n = len(plain) // 4 if n is None else n
    planes = np.frombuffer(plain, dtype=np.uint8, count=4 * n).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1), plain[4 * n :]
