"""Content-chosen anchors: every string of `LENGTH` bytes holds one, at the same place wherever it occurs."""

from __future__ import annotations

import numpy as np

LENGTH = 400
GRAM = 16
SPAN = LENGTH - GRAM  # an anchor begins at most this far into the string it belongs to
_SEGMENT = 1 << 20
_INDEX = np.uint64(_SEGMENT - 1)


def gram_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of the 16 bytes at every position."""
    n = len(raw) - GRAM + 1
    low = np.ndarray((n,), dtype="<u8", buffer=raw, strides=(1,))
    high = np.ndarray((n,), dtype="<u8", buffer=raw, offset=8, strides=(1,))
    h = low * np.uint64(0x9E3779B97F4A7C15)
    h ^= (high ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    return h


def _least(h: np.ndarray) -> np.ndarray:
    """The leftmost place of the smallest hash in every window of `SPAN + 1` places."""
    width = SPAN + 1
    n = len(h)
    packed = (h & ~_INDEX) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    return (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _INDEX).astype(np.int64)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text; none if it is shorter than `LENGTH`."""
    if len(raw) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, hashes = [], []
    step = _SEGMENT - LENGTH
    for begin in range(0, len(raw) - LENGTH + 1, step):
        h = gram_hashes(raw[begin : begin + _SEGMENT])
        if len(h) <= SPAN:
            break
        least = _least(h)
        at = least[np.append(True, least[1:] != least[:-1])]
        places.append(at + begin)
        hashes.append(h[at])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]
