"""Words of many texts at once, on their UTF-8 bytes, with 64-bit hashes; all array operations."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)
STRETCH = 1 << 18


class _Powers:
    """Powers of the hash base and of its inverse, grown as longer buffers come."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate((cls.up, cls.up * np.uint64(pow(_P, k, 1 << 64))))
            cls.down = np.concatenate((cls.down, cls.down * np.uint64(pow(_INV, k, 1 << 64))))
        return cls.up[:n], cls.down[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte span of ``buf`` (spans ascending): equal bytes, equal hash,
    wherever they stand. Different words collide with a chance of about 2**-64 a pair. The buffer is
    worked through in stretches of ``STRETCH`` bytes or one longer span."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        at = starts[i]
        j = max(int(np.searchsorted(ends, at + STRETCH, side="right")), i + 1)
        part = buf[at: ends[j - 1]]
        up, down = _Powers.to(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    out ^= out >> np.uint64(31)
    return out * np.uint64(0xD6E8FEB86659FD93)


def word_spans(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which the 256-entry table ``is_word`` holds."""
    inside = np.concatenate(([False], is_word[buf], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def join_texts(texts: list[bytes | None], pad: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one lower-cased (A-Z) byte buffer, ``pad`` spaces after each, and their starts."""
    texts = [t or b"" for t in texts]
    buf = np.frombuffer((b" " * pad).join([*texts, b""]).lower(), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + pad
    return buf, np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
